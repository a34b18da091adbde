"""The filter audit against plain counting, on tables with every awkward case."""

from itertools import permutations

import duckdb
import pytest
from pyspark.sql import functions as F

from cadence.llm import filter_audit, oracle, queries
from tests.conftest import SF_SMALL
from tests.llm.tables import awkward, clashing, documents, prose, row

COLUMNS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def brute(rows, labels):
    """Apply each order of the filters, left to right, to lists of documents."""
    least = {}
    for k, t, *_ in rows:
        if k is not None:
            least[t or ""] = min(k, least.get(t or "", k))
    docs = []
    for k, t, _, source, _ in rows:
        words = (t or "").encode().split()
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
                 "C": 100 * sum("A" <= c <= "Z" for c in t or "") > 2 * len(t or ""), "D": any(c in "#$%&*|" for c in t or ""),
                 "E": k is not None and k > least[t or ""]}
        good = any(i == k and q == 1 for i, q, _ in labels if k is not None)
        toxic = any(i == k and x == 1 for i, _, x in labels if k is not None)
        docs.append((source or "", {f for f in fails if fails[f]}, good, toxic))
    out = {}
    for part in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == part]
        for order in permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                out[part, "".join(order), step] = [len(left), len(gone), sum(f in d[1] for d in own) - len(gone), sum(d[1] == {f} for d in own),
                                                   sum(d[2] for d in gone), sum(d[3] for d in gone)]
        for f in "ABCDE":
            keys = [(part, "".join(o), o.index(f) + 1) for o in permutations("ABCDE")]
            total = sum(out[k][1] for k in keys)
            for k in keys:
                out[k].append(total)
    return out


def rows_and_labels():
    rows = awkward() + [row(100 + k, prose(150 + 3 * k, k % 20), ("a", "b", None, "")[k % 4]) for k in range(60)]
    rows += [row(300 + k, "SAME Text 5 % off " * 60, "hot") for k in range(40)] + [row(300, "SAME Text 5 % off " * 60, "hot"), row(None, prose(150, 0), "a")]
    labels = [(k, k % 2, int(k % 3 == 0)) for k in range(0, 400, 3)] + [(300, 1, 0), (300, 0, None), (9999, 1, 1), (None, 1, 1), (6, None, 1)]
    return rows, labels


@pytest.mark.parametrize("sketch_bytes", [filter_audit.SKETCH_BYTES, 1])
def test_audit_against_plain_counting(spark, sketch_bytes):
    rows, labels = rows_and_labels()
    docs = clashing(documents(spark, rows), ["part", "mask", "digest", "first", "n", "step"])
    frame = clashing(spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"), ["text", "good", "part"])
    got = filter_audit.audit(docs, frame, F.col("source"), sketch_bytes=sketch_bytes).collect()
    assert {(r.part, r.filter_order, r.step): [getattr(r, c) for c in COLUMNS] for r in got} == brute(rows, labels)
    assert len(got) == 600 * len({r[3] or "" for r in rows})


def test_empty_tables(spark):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert filter_audit.audit(documents(spark, []), labels, F.col("source")).count() == 0
    got = filter_audit.audit(documents(spark, [row(1, None)]), labels, F.col("source")).collect()
    assert len(got) == 600 and {r.good_lost for r in got} == {0}


def test_unique_texts_are_cleared_before_any_text_moves(spark):
    rows = [row(k, prose(30, k)) for k in range(2000)] + [row(5000 + k, prose(30, k)) for k in range(50)]
    found = filter_audit.failures(documents(spark, rows), F.col("source"))
    shown = {r.doc_id for r in found.filter("text IS NOT NULL").collect()}
    assert shown >= {*range(50), *range(5000, 5050)} and len(shown) < 100 + 0.03 * 2000
    assert found.filter("(text IS NULL) <> (digest IS NULL)").count() == 0


def test_sketch_grows_with_the_table_up_to_its_bound():
    assert filter_audit.sketch_slots(0) == 1 << 10
    assert filter_audit.sketch_slots(1_000_000) == 1 << 24
    assert filter_audit.sketch_slots(10**12) == 8 * filter_audit.SKETCH_BYTES


def test_query_against_sql(spark):
    got = queries.op12_filter_orders(spark, SF_SMALL).collect()
    db = duckdb.connect()
    for name in ("documents", "labels"):
        db.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF_SMALL}/{name}.parquet'")
    want = db.sql(oracle.SQL["op12_filter_orders"])
    assert sorted(map(tuple, got)) == sorted(tuple(dict(zip(want.columns, r))[c] for c in got[0].__fields__) for r in want.fetchall())
