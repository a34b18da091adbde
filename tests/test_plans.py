"""Properties of the physical plans the library relies on at scale."""

import re

import pytest

from pyspark.sql import functions as F

from cadence.config import Config
from cadence.functions import columns as fn
from cadence.operators import quality
from cadence.plans.datasets import Workspace
from cadence.sources import ingest
from cadence.sources.fixtures import raw_tables
from tests.conftest import SF_SMALL


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def built(spark):
    import tempfile

    cfg = Config(root=tempfile.mkdtemp(prefix="cadence-plans-")).with_fixture_calendar()
    ingest.ingest(spark, raw_tables(spark, SF_SMALL), cfg)
    return Workspace(spark, ingest.LoadedRaw(spark, cfg), cfg)


def test_no_python_in_dataset_plans(built):
    for name in ("fct_orders", "fct_order_items", "fct_stocks", "rpt_sales", "rpt_orders",
                 "rpt_stocks", "dim_staffs"):
        plan = plan_of(built[name])
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name
        assert "PythonUDF" not in plan, name


def test_fct_orders_prunes_and_pushes_down(built):
    plan = plan_of(built["fct_orders"])
    # lines: only the columns revenue and totals need, filter pushed to the scan
    assert re.search(r"ReadSchema: struct<order_id:bigint,quantity:bigint,list_price:decimal"
                     r"\(16,6\),discount:decimal\(9,8\)>", plan)
    assert "PushedFilters: [IsNotNull(order_id)]" in plan
    # partial aggregation before the shuffle on order_id
    assert "partial_sum" in plan and "hashpartitioning(order_id" in plan


def test_kpi_filter_reaches_the_scan(spark, built, tmp_root):
    from cadence.operators import kpi
    from cadence.sources import store

    rpt = store.write_and_publish(built["rpt_sales"], f"{tmp_root}/rpt_sales")
    plan = plan_of(kpi.revenue_store_month(rpt, {"store_state": "EUROPE"}))
    assert "PushedFilters: [IsNotNull(store_state), EqualTo(store_state,EUROPE)]" in plan
    assert "partial_sum" in plan


def test_suite_reads_each_dataset_three_times(built):
    tests = quality.declared_for("fct_order_items")
    plan = plan_of(quality.evaluate(built, tests, []))
    # the fact is built from two staging views; count the scans of the raw
    # order lines: one per pass (row-level fold, own keys, foreign keys)
    scans = re.findall(r"FileScan parquet \[[^\]]*\] Batched: true, DataFilters: \[[^\]]*\], "
                       r"Format: Parquet, Location: InMemoryFileIndex\(\d+ paths\)\[[^\]]*"
                       r"public_order_items", plan)
    assert len(scans) == 3


def test_rpt_sales_shuffles_lines_for_the_header_and_products_only(spark, built):
    """With broadcast off: order-level dimensions join one row per order."""
    conf = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k in conf:
            spark.conf.set(k, "-1")
        from cadence.operators import reporting
        from cadence.plans.datasets import Env

        inputs = {n: built[n] for n in ("fct_order_items", "dim_products", "dim_stores",
                                        "dim_customers", "dim_staffs", "dim_date")}
        df = reporting.rpt_sales(env=Env(spark, built.env.cfg), **inputs)
        plan = plan_of(df)
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    wide = [x for x in plan.split("\n") if "Exchange hashpartitioning" in x]
    assert sum("hashpartitioning(product_id" in x for x in wide) <= 4
    assert len([x for x in wide if "hashpartitioning(customer_id" in x]) == 2


def test_only_the_calendar_is_hinted_for_broadcast(built):
    plan = built["rpt_sales"]._jdf.queryExecution().optimizedPlan().toString()
    hints = re.findall(r"strategy=broadcast", plan)
    assert len(hints) == 1


def test_partitioned_reporting_tables_prune_by_month(spark, tmp_root):
    from cadence.plans.build import SUCCESS, build
    from cadence.sources import store

    cfg = Config(root=tmp_root, partition_tables=True).with_fixture_calendar()
    loads = ingest.ingest(spark, raw_tables(spark, SF_SMALL), cfg)
    result = build(spark, ingest.LoadedRaw(spark, cfg, loads), cfg,
                   select=["rpt_orders"], run_tests=False)
    assert result.status("rpt_orders") == SUCCESS
    table = store.read_current(spark, cfg.dataset_dir("reporting", "rpt_orders"))
    lazy = Workspace(spark, ingest.LoadedRaw(spark, cfg, loads), cfg)["rpt_orders"]
    assert table.count() == lazy.count()
    month = table.where("order_year_month = '1997-03'")
    plan = plan_of(month)
    assert "PartitionFilters: [isnotnull(order_year_month" in plan
    assert month.count() == lazy.where("order_year_month = '1997-03'").count()


def test_one_pass_suite_reads_once_and_agrees(built):
    tests = quality.declared_for("fct_order_items")
    two = sorted(tuple(r) for r in quality.evaluate(built, tests, []).collect())
    single = quality.evaluate(built, tests, [], one_pass=True)
    assert sorted(tuple(r) for r in single.collect()) == two
    scans = re.findall(r"FileScan parquet \[[^\]]*\] Batched: true, DataFilters: \[[^\]]*\], "
                       r"Format: Parquet, Location: InMemoryFileIndex\(\d+ paths\)\[[^\]]*"
                       r"public_order_items",
                       plan_of(quality.evaluate(built, tests, [], one_pass=True)))
    assert len(scans) == 1


def test_store_and_date_text_joins_the_lines_last(built):
    """Broadcast after the shuffles on the order and the product, not carried through them."""
    plan = built["rpt_sales"]._jdf.queryExecution().optimizedPlan().toString()
    assert re.findall(r"Join LeftOuter, \((\w+)#", plan)[:3] == ["order_date", "store_id", "product_id"]


def test_monthly_tables_are_dealt_without_the_text_that_small_tables_add(spark, tmp_root):
    from cadence.plans.build import SUCCESS, build
    from cadence.sources import store

    cfg = Config(root=tmp_root).with_fixture_calendar()
    raw = raw_tables(spark, SF_SMALL)
    names = ["rpt_sales", "rpt_orders"]
    result = build(spark, raw, cfg, select=names, run_tests=False,
                   adjust={"rpt_orders": lambda df: df.where("order_id % 2 = 0")})
    lazy = Workspace(spark, raw, cfg)
    for name in names:
        assert result.status(name) == SUCCESS
        rows, _, dealt_by = lazy.halves(name)
        assert dealt_by in rows.columns
        assert not {"store_name", "order_month_name", "order_year_month", "order_item_key"} & set(rows.columns)
        written = store.read_current(spark, cfg.dataset_dir("reporting", name))
        expected = lazy[name] if name == "rpt_sales" else lazy[name].where("order_id % 2 = 0")
        written = written.select(*expected.columns)
        assert next(d.n_rows for d in result.datasets if d.dataset == name) == expected.count() > 0
        assert written.exceptAll(expected).isEmpty() and expected.exceptAll(written).isEmpty()


def test_stock_text_of_stores_joins_last(built):
    plan = built["rpt_stocks"]._jdf.queryExecution().optimizedPlan().toString()
    assert re.findall(r"Join LeftOuter, \((\w+)#", plan)[:2] == ["store_id", "product_id"]


def test_whole_sales_leave_out_of_shuffles_what_follows_from_other_columns(spark, built):
    from cadence.operators import reporting

    whole = Workspace(spark, raw_tables(spark, SF_SMALL), built.env.cfg, whole=True)
    lines = [whole[n] for n in ("fct_order_items", "dim_products", "dim_customers", "dim_staffs")]
    rows = reporting.sales_rows(whole.env, *lines)
    assert not {"order_item_key", "revenue"} & set(rows.columns)
    # A query of some columns would have to carry all that revenue follows from.
    assert "revenue" in reporting.sales_rows(built.env, *lines).columns
    lazy = Workspace(spark, raw_tables(spark, SF_SMALL), built.env.cfg)
    for name in ("rpt_sales", "rpt_orders", "fct_order_items"):
        assert whole[name].dtypes == lazy[name].dtypes
        assert whole[name].exceptAll(lazy[name]).isEmpty() and lazy[name].exceptAll(whole[name]).isEmpty()


def test_item_numbers_need_no_ship_date(spark):
    plan = raw_tables(spark, SF_SMALL)["order_items"]._jdf.queryExecution().optimizedPlan().toString()
    assert "l_suppkey" in plan.split("Relation")[0] and "l_shipdate" not in plan.split("Relation")[0]


@pytest.mark.parametrize("odd", [False, True])
def test_sales_lines_dealt_to_months_meet_their_orders_as_in_a_join(spark, tmp_root, odd):
    """Also lines of no order or date, an order with two headers, two products and
    customers of one key, another key or revenue than that of the line."""
    import datetime as dt
    import decimal
    import glob

    from cadence.operators import reporting
    from cadence.plans.datasets import Env
    from cadence.sources import store

    days = [dt.date(1996, 1 + k % 3, 1 + k % 28) for k in range(90)]
    money = decimal.Decimal("1.50")
    lines = [(f"k{i}", i // 4, i % 4 + (i == 8) * 9000, i % 7, i // 4 % 5, i // 4 % 3, i // 4 % 2, days[i // 4], i // 4 % 4, 2,
              decimal.Decimal(1), decimal.Decimal("0.25"), money) for i in range(360)]
    if odd:
        lines += [("null", None, 1, 1, 1, 1, 1, days[0], 1, 2, decimal.Decimal(1), decimal.Decimal(0), money),
                  ("date", 700, 1, 1, 1, 1, 1, None, 1, 2, decimal.Decimal(1), decimal.Decimal(0), None),
                  ("two", 3, 9, 2, 4, 2, 1, dt.date(1999, 9, 9), 1, 2, decimal.Decimal(1), decimal.Decimal(0), money)]
    sales = spark.createDataFrame(
        lines, "order_item_key string, order_id bigint, item_id bigint, product_id bigint, customer_id bigint, store_id bigint, "
        "staff_id bigint, order_date date, order_status bigint, quantity bigint, list_price decimal(16,6), discount decimal(9,8), "
        "revenue decimal(18,2)")
    sales = sales.withColumn("order_item_key", F.when(F.col("order_id") % 2 == 0, fn.surrogate_key(["order_id", "item_id"]))
                             .otherwise(F.col("order_item_key")))
    extra = [1] if odd else []
    products = spark.createDataFrame([(i, f"p{i}", "b", "c", 2016) for i in [*range(6), *extra]],
                                     "product_id bigint, product_name string, brand_name string, category_name string, model_year bigint")
    customers = spark.createDataFrame([(i, f"c{i}", "city", "state") for i in [*range(4), *extra]],
                                      "customer_id bigint, full_name string, city string, state string")
    staffs = spark.createDataFrame([(0, "s0"), (1, "s1")], "staff_id bigint, full_name string")
    stores = spark.createDataFrame([(0, "n", "c", "s")], "store_id bigint, store_name string, city string, state string")
    cfg = Config(root=tmp_root).with_fixture_calendar()
    env = Env(spark, cfg)
    from cadence.operators.marts import dim_date

    dates = dim_date(env)
    want = reporting.rpt_sales(env, sales, products, stores, customers, staffs, dates)
    assert reporting._one_header_each(sales) == (not odd)
    rows = reporting.dealt_sales_rows(env, sales, products, customers, staffs)
    got = reporting.sales_text(rows, env, stores, dates)
    assert got.schema.simpleString() == want.schema.simpleString()
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty() and want.count() >= 360
    # The parts of a month are few files, without another shuffle of the rows.
    version = store.write_version(rows, f"{tmp_root}/sales", ["order_year_month"], reporting.DEAL,
                                  lambda dealt: reporting.sales_text(dealt, env, stores, dates), True)
    months = glob.glob(f"{tmp_root}/sales/{version}/*/")
    parts = reporting.DEALS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert len(glob.glob(f"{tmp_root}/sales/{version}/*/*.parquet")) <= parts + len(months)
    plan = plan_of(rows)
    assert len(re.findall(r"Exchange hashpartitioning\(_deal#\d+L, \d+\), REPARTITION_BY_COL", plan)) == 1
