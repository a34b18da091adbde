"""A customer holding a third of the lines: the sort-merge join to the
customer dimension is split by AQE instead of landing in one task, and the
KPI aggregation combines map-side."""

from pyspark.sql import functions as F

from cadence.operators import kpi


def test_hot_key_left_join_is_split_by_aqe(spark):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        lines = spark.range(30000).select(
            F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 5000)
            .cast("bigint").alias("customer_id"),
            F.col("id").alias("line_id"),
        )
        customers = spark.range(5000).select(
            F.col("id").alias("customer_id"), F.concat(F.lit("c"), F.col("id")).alias("name"))
        joined = lines.join(customers, "customer_id", "left")
        assert len(joined.collect()) == 30000   # runs this plan, so AQE finalises it
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "isFinalPlan=true" in plan
        assert "isSkewJoin=true" in plan or "skew=true" in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_key_tests_send_no_fact_rows_of_one_key_to_one_task(spark):
    """The join with the parents sees foreign keys only, spread evenly: not the
    fact's own unique keys, which have no parent."""
    from cadence.operators import quality
    from cadence.operators.quality import Expectation

    lines = spark.range(20000).select(
        F.col("id").alias("line_key"), (F.col("id") / 2).cast("bigint").alias("order_id"),
        F.when(F.col("id") % 3 > 0, F.col("id") % 4000).alias("product_id"))
    products = spark.range(4000).select(F.col("id").alias("product_id"))
    tests = [Expectation("lines", "unique", ("line_key",)),
             Expectation("lines", "unique_combination", ("order_id", "line_key")),
             Expectation("lines", "relationships", ("product_id",),
                         {"to": "products", "field": "product_id"})]
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    frames = {"lines": lines, "products": products}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        for one_pass in (False, True):
            rows = quality.evaluate(frames, tests, [], one_pass=one_pass).collect()
            assert [r.n_violations for r in rows] == [0, 0, 0]
        counts, gid = quality._key_counts(lines, [("line_key",), ("product_id",)])
        joined = quality._join_parents(counts, tests[2:], gid, frames)
        sizes = [r[0] for r in joined.groupBy(
            F.pmod(F.hash(F.col(quality._GID), "_key"), F.lit(8))).count().select("count").collect()]
        assert len(sizes) == 8 and max(sizes) < 2 * sorted(sizes)[4]
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_store_revenue_is_exact(spark):
    sales = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 7).cast("bigint")
        .alias("store_id"),
        F.lit("s").alias("store_name"),
        F.lit("2020-01").alias("order_year_month"),
        F.lit(2).cast("bigint").alias("quantity"),
        F.lit(1.25).cast("decimal(18,2)").alias("revenue"),
    )
    got = {r["store_id"]: r["revenue"] for r in kpi.revenue_store_month(sales).collect()}
    assert sum(got.values()) == 9000 * 1.25
    plan = kpi.revenue_store_month(sales)._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan
