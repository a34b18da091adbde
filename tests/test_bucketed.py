"""Facts from bucketed tables: no shuffle on the order key, the same rows; skewed keys stay plain."""

import pytest
from pyspark.sql import functions as F

from cadence import queries
from cadence.sources import bucketed
from tests.conftest import SF_SMALL
from tests.test_plans import plan_of


@pytest.fixture()
def no_broadcast(spark):
    conf = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in conf}
    for k in conf:
        spark.conf.set(k, "-1")
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def same_rows(got, want):
    assert got.columns == want.columns
    return got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_facts_without_a_shuffle(spark, no_broadcast):
    ws = queries.co_located_workspace(spark, SF_SMALL, "test")
    plain = queries.workspace(spark, SF_SMALL)
    for name in ("fct_orders", "fct_order_items"):
        plan = plan_of(ws[name])
        assert "Bucketed: true" in plan and "SortMergeJoin" in plan
        assert "Exchange" not in plan, name
        assert "Exchange" in plan_of(plain[name])
        assert same_rows(ws[name], plain[name])


def test_a_key_with_a_third_of_the_rows_stays_plain(spark, tmp_root, no_broadcast):
    lines = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), "id")
    heads = spark.range(9000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    assert bucketed.balanced(heads, "k", 32) and not bucketed.balanced(lines, "k", 32)
    got = bucketed.co_located({"lines": lines, "heads": heads}, tmp_root, "k", 32)
    joined = got["lines"].join(got["heads"], "k")
    assert "Exchange" in plan_of(joined)
    assert same_rows(joined, lines.join(heads, "k"))


def test_null_keys_empty_tables_and_another_session(spark, tmp_root, no_broadcast):
    some = spark.range(1000).select(F.when(F.col("id") % 100 > 0, F.col("id")).alias("k"), F.col("id").alias("Odd name"))
    none = some.limit(0)
    got = bucketed.co_located({"some": some, "none": none}, tmp_root, "k", 8)
    assert same_rows(got["some"], some) and got["none"].count() == 0
    table = bucketed.write(some, f"{tmp_root}/again", "k", 8)
    other = bucketed.read(spark.newSession(), table)
    assert other.count() == 1000
    totals = bucketed.read(spark, table).groupBy("k").count()
    assert "Exchange" not in plan_of(totals)
    assert totals.where("k is null").first()["count"] == 10
