"""Numbering within a key equals a window, also when one key holds most rows,
when keys are NULL, and for numbers that doubles cannot hold."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cadence.operators.numbering import number_within_key


def _frame(spark):
    # key 7 holds 30,000 of 34,000 rows; ties on "o" are broken by "t".
    hot = spark.range(30000).select(F.lit(7).cast("bigint").alias("k"), F.col("id").alias("o"),
                                    F.col("id").alias("t"))
    cold = spark.range(4000).select(
        F.when(F.col("id") % 9 > 0, F.col("id") % 40).alias("k"),
        F.when(F.col("id") % 5 > 0, F.col("id") % 3 + 9007199254740992).alias("o"),
        F.col("id").alias("t"))
    return hot.unionByName(cold)


def _same(df, order, spark):
    w = Window.partitionBy("k").orderBy(*order)
    expected = df.withColumn("n", F.row_number().over(w).cast("bigint"))
    got = number_within_key(df, "k", order, "n")
    assert got.columns == expected.columns
    assert expected.exceptAll(got).count() == 0 and got.exceptAll(expected).count() == 0


def test_numbers_as_a_window_does(spark):
    _same(_frame(spark), ["o", "t"], spark)


@pytest.mark.parametrize("kind", ["string", "double", "date", "timestamp"])
def test_other_order_types(spark, kind):
    df = _frame(spark).where("o < 40000 or o is null")
    o = {"string": F.col("o").cast("string"), "double": F.col("o") * 1.5 - 100,
         "date": F.date_add(F.lit("1990-01-01").cast("date"), F.col("o").cast("int")),
         "timestamp": F.timestamp_seconds(F.col("o") * 1000)}[kind]
    _same(df.withColumn("o", o), ["o", "t"], spark)


def test_no_job_runs_and_the_hot_key_is_spread(spark):
    group = "numbering-plan"
    spark.sparkContext.setJobGroup(group, "plan")
    got = number_within_key(_frame(spark), "k", ["o", "t"], "n")
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "SinglePartition" not in plan
    assert "_stretch" in plan and "hashpartitioning(k" in plan


def test_rows_are_shuffled_once(spark):
    conf = ("spark.sql.autoBroadcastJoinThreshold", "-1")
    old = spark.conf.get(conf[0])
    spark.conf.set(*conf)
    try:
        got = number_within_key(_frame(spark), "k", ["o", "t"], "n")
        plan = got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(conf[0], old)
    # The rows, the counts per stretch, their running sum, and the first numbers.
    assert plan.count("Exchange hashpartitioning") == 4


def test_queries_that_do_not_read_the_number_have_no_join(spark):
    numbered = number_within_key(_frame(spark), "k", ["o", "t"], "n")
    assert "Join" not in numbered.select("k", "t")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" in numbered._jdf.queryExecution().optimizedPlan().toString()
