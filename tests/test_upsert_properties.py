"""Upsert properties on generated tables: key-unique,
idempotent, nothing deleted, batch rows win."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cadence.sources import ingest

rows = st.lists(st.tuples(st.integers(0, 6), st.sampled_from(["a", "b", "c"])), max_size=8)


def _frame(spark, data):
    return spark.createDataFrame(data, "id bigint, v string")


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(current=rows, batch=rows)
def test_upsert_properties(spark, current, batch):
    # the stored table is key-unique by construction
    current = list({k: v for k, v in current}.items())
    cur = _frame(spark, current)
    bat = _frame(spark, batch)
    once = ingest.upsert(cur, bat, ["id"], seq=None)
    got = {r["id"]: r["v"] for r in once.collect()}
    assert once.count() == len(got)                                   # key-unique
    assert set(got) == {k for k, _ in current} | {k for k, _ in batch}  # nothing deleted
    for k in {k for k, _ in batch}:                                    # batch wins
        assert got[k] == max(v for kk, v in batch if kk == k)
    twice = ingest.upsert(once, bat, ["id"], seq=None)
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, once.collect()))
