"""Registered queries: ``(spark, sf_dir) -> DataFrame``, one per operator
of SURVEY §2, each over the whole of the driver's tables.

Datasets are resolved lazily from the raw tables, so every query is one
Catalyst plan from parquet scans to result.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadence.catalog import TABLES_BY_NAME
from cadence.config import DEFAULT_CALENDAR_END, DEFAULT_CALENDAR_START, Config, default_config
from cadence.functions import calendar_columns, columns as fn
from cadence.operators import kpi, quality, rollup
from cadence.operators.marts import calendar, order_calendar
from cadence.plans.build import build
from cadence.plans.datasets import Workspace
from cadence.sources import bucketed, fixtures, ingest, reconcile, store
from cadence.sources.fixtures import raw_tables
from cadence.sources.testdata import TestData

QueryFn = Callable[[SparkSession, str], DataFrame]


def fixture_config() -> Config:
    return Config().with_fixture_calendar()


def workspace(spark: SparkSession, sf_dir: str, cfg: Config | None = None, whole: bool = False) -> Workspace:
    return Workspace(spark, raw_tables(spark, sf_dir), cfg or fixture_config(), whole=whole)


def _dataset_query(name: str) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return workspace(spark, sf_dir, whole=True)[name]

    run.__name__ = name
    return run


DATASET_QUERIES = (
    "stg_brands",
    "stg_categories",
    "stg_customers",
    "stg_order_items",
    "stg_orders",
    "stg_products",
    "stg_staffs",
    "stg_stocks",
    "stg_stores",
    "int_order_items_enriched",
    "dim_customers",
    "dim_stores",
    "dim_products",
    "dim_staffs",
    "fct_order_items",
    "fct_orders",
    "fct_stocks",
    "rpt_sales",
    "rpt_orders",
    "rpt_stocks",
)


def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar generated from the first to the last order's year."""
    return order_calendar(workspace(spark, sf_dir)["stg_orders"])


def _sales_kpi(fn: Callable[[DataFrame], DataFrame]) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(workspace(spark, sf_dir)["rpt_sales"])

    return run


def _orders_kpi(fn: Callable[[DataFrame], DataFrame]) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(workspace(spark, sf_dir)["rpt_orders"])

    return run


def _stocks_kpi(fn: Callable[[DataFrame], DataFrame]) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(workspace(spark, sf_dir)["rpt_stocks"])

    return run


def kpi_turnover(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = workspace(spark, sf_dir)
    return kpi.turnover(ws["rpt_sales"], ws["rpt_stocks"])


KPI_QUERIES: dict[str, QueryFn] = {
    "kpi_revenue_store_month": _sales_kpi(kpi.revenue_store_month),
    "kpi_revenue_state": _sales_kpi(kpi.revenue_state),
    "kpi_revenue_period": _sales_kpi(kpi.revenue_period),
    "kpi_top_products": _sales_kpi(kpi.top_products),
    "kpi_top_categories": _sales_kpi(kpi.top_categories),
    "kpi_top_brands": _sales_kpi(kpi.top_brands),
    "kpi_customer_value": _sales_kpi(kpi.customer_value),
    "kpi_top_customers": _sales_kpi(kpi.top_customers),
    "kpi_customer_geo": _sales_kpi(kpi.customer_geo),
    "kpi_sales_staff": _sales_kpi(kpi.sales_staff),
    "kpi_weekday": _sales_kpi(kpi.weekday_sales),
    "kpi_late_rate": _orders_kpi(kpi.late_rate),
    "kpi_shipping_delay": _orders_kpi(kpi.shipping_delay),
    "kpi_status_mix": _orders_kpi(kpi.status_mix),
    "kpi_revenue_per_order": _orders_kpi(kpi.revenue_per_order),
    "kpi_backlog": _orders_kpi(kpi.backlog),
    "kpi_stock_store": _stocks_kpi(kpi.stock_store),
    "kpi_stockouts": _stocks_kpi(kpi.stockout_rate),
    "kpi_stockout_list": _stocks_kpi(kpi.stockout_list),
    "kpi_turnover": kpi_turnover,
    "kpi_revenue_store_month_filtered": _sales_kpi(
        lambda s: kpi.revenue_store_month(s, {"store_state": "EUROPE"})
    ),
    "kpi_revenue_state_of_brands": _sales_kpi(
        lambda s: kpi.revenue_state(s, {"brand_name": ["Brand#11", "Brand#22"]})
    ),
    "kpi_stock_store_out_of_stock": _stocks_kpi(
        lambda s: kpi.stock_store(s, {"is_out_of_stock": True})
    ),
}


# --- ingestion and reconciliation (I4-I12) -------------------------------------

# Fixed values that results depend on: the day the first load ran, how far
# back the second load's extraction window reaches, and the load id used
# where lineage must be reproducible.
FIRST_LOAD_DAY = dt.date(1998, 1, 1)
EXTRACT_OVERLAP_DAYS = 30
FIXED_LOAD_ID = "load-0001"


def run_config(spark: SparkSession, tag: str) -> Config:
    """A fresh folder in the shared storage for one query run."""
    return default_config(spark, run_name=f"{tag}-{dt.datetime.now():%Y%m%d%H%M%S%f}")


def _window_start() -> dt.date:
    return FIRST_LOAD_DAY - dt.timedelta(days=EXTRACT_OVERLAP_DAYS)


def load_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I4: stocks replaced twice (two runs); the table holds one copy."""
    cfg = run_config(spark, "load_replace")
    table = TABLES_BY_NAME["stocks"]
    src = raw_tables(spark, sf_dir)
    for run in ("run-1", "run-2"):
        ingest.load_table(spark, src["stocks"], table, cfg, run)
    return ingest.read_raw(spark, cfg, "stocks")


def _incremental_orders_batch(src: TestData) -> DataFrame:
    """Second extraction: orders changed since the overlap window began,
    sent twice (an earlier and a later extract, ``_seq`` 1 and 2)."""
    early = fixtures.orders_changed_since(src, _window_start()).withColumn("_seq", F.lit(1))
    late = fixtures.orders_changed_since(src, FIRST_LOAD_DAY).withColumn("_seq", F.lit(2))
    return early.unionByName(late)


def load_merge_single_pk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I5 on orders: first load on FIRST_LOAD_DAY, then an incremental
    batch with duplicate keys upserted on order_id."""
    cfg = run_config(spark, "load_merge_single_pk")
    table = TABLES_BY_NAME["orders"]
    src = TestData(spark, sf_dir)
    ingest.load_table(spark, fixtures.orders_as_of(src, FIRST_LOAD_DAY), table, cfg, "day-1")
    ingest.load_table(spark, _incremental_orders_batch(src), table, cfg, "day-2")
    return ingest.read_raw(spark, cfg, "orders")


def load_merge_composite_pk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I5 on order_items, key (order_id, item_id): lines of the orders
    placed by FIRST_LOAD_DAY, then the lines of the orders placed in the
    overlap window or later."""
    cfg = run_config(spark, "load_merge_composite_pk")
    table = TABLES_BY_NAME["order_items"]
    src = TestData(spark, sf_dir)
    first = fixtures.order_items_as_of(src, FIRST_LOAD_DAY)
    batch = fixtures.order_items_placed_after(src, _window_start())
    ingest.load_table(spark, first, table, cfg, "day-1")
    ingest.load_table(spark, batch, table, cfg, "day-2")
    return ingest.read_raw(spark, cfg, "order_items")


def load_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loaded stocks with their load id and deterministic row id."""
    cfg = run_config(spark, "load_lineage")
    table = TABLES_BY_NAME["stocks"]
    ingest.load_table(spark, raw_tables(spark, sf_dir)["stocks"], table, cfg, FIXED_LOAD_ID)
    return store.read_current(spark, cfg.dataset_dir("raw", cfg.raw_table_name("stocks")))


def load_schema_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first load comes from a source without ``required_date``;
    the second, with it, is merged: rows it did not touch keep NULL."""
    cfg = run_config(spark, "load_schema_evolution")
    table = TABLES_BY_NAME["orders"]
    src = TestData(spark, sf_dir)
    old_schema = fixtures.orders_as_of(src, FIRST_LOAD_DAY).drop("required_date")
    ingest.load_table(spark, old_schema, table, cfg, "day-1")
    ingest.load_table(spark, _incremental_orders_batch(src), table, cfg, "day-2")
    return ingest.read_raw(spark, cfg, "orders")


def load_merge_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I5 as a stream: the first-day extract and the incremental extract
    land as change files; a file-source stream upserts them on order_id."""
    from cadence.streaming import change_stream, start_upsert_stream

    cfg = run_config(spark, "load_merge_stream")
    src = TestData(spark, sf_dir)
    landing = f"{cfg.root}/landing/orders"
    first = fixtures.orders_as_of(src, FIRST_LOAD_DAY).withColumn("_seq", F.lit(0))
    first.write.parquet(f"{landing}/extract-1")
    _incremental_orders_batch(src).write.parquet(f"{landing}/extract-2")
    table_dir = cfg.dataset_dir("raw", cfg.raw_table_name("orders"))
    changes = change_stream(spark, f"{landing}/*", first.schema)
    query = start_upsert_stream(changes, table_dir, TABLES_BY_NAME["orders"].key,
                                f"{cfg.root}/_checkpoints/orders", name="orders")
    query.awaitTermination()
    return store.read_current(spark, table_dir).drop(*ingest.TRACE)


def load_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The load log after loading all nine tables under one load id."""
    cfg = run_config(spark, "load_log")
    ingest.ingest(spark, raw_tables(spark, sf_dir), cfg, load_id=FIXED_LOAD_ID)
    return ingest.read_load_log(spark, cfg).select(
        "load_id", "table_name", "load_mode", "emitted_rows"
    )


def recon_source_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I8: COUNT(*) per source table, one union of aggregates."""
    return reconcile.source_counts(spark, raw_tables(spark, sf_dir), Config())


def recon_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load all nine tables, then source = emitted = stored."""
    cfg = run_config(spark, "recon_checks")
    src = raw_tables(spark, sf_dir)
    results = ingest.ingest(spark, src, cfg)
    return reconcile.reconcile(spark, src, cfg, results)


def load_selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the tables asked for are loaded, under their destination names."""
    cfg = run_config(spark, "load_selected")
    ingest.ingest(spark, raw_tables(spark, sf_dir), cfg, only=["Stocks", "ORDERS", "nope"])
    return ingest.read_load_log(spark, cfg).select(
        "table_name", "source_table", "load_mode", "emitted_rows"
    )


def load_merge_null_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A merge on a key with NULL parts, loaded three times, keeps one
    row per key: positions without stock have no store here."""
    cfg = run_config(spark, "load_merge_null_key")
    stocks = raw_tables(spark, sf_dir)["stocks"]
    batch = stocks.withColumn("store_id", F.when(F.col("quantity") > 0, F.col("store_id")))
    table_dir = cfg.dataset_dir("raw", "nullable_stocks")
    for run in ("run-1", "run-2", "run-3"):
        ingest.merge_load(batch, table_dir, ["store_id", "product_id"], run)
    return store.read_current(spark, table_dir).drop(*ingest.TRACE)


def load_merge_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second batch holds each order twice, with an older sequence
    number and another status: nothing stored changes, and what the load
    emitted is what the batch held."""
    cfg = run_config(spark, "load_merge_late_rows")
    columns = ["order_id", "customer_id", "order_status"]
    orders = raw_tables(spark, sf_dir)["orders"].select(*columns)
    table_dir = cfg.dataset_dir("raw", "late_orders")
    _, first = ingest.merge_load(orders.withColumn("_seq", F.lit(2)), table_dir, ["order_id"],
                                 "day-1")
    older = orders.withColumn("order_status", F.lit(9).cast("bigint"))
    older = older.withColumn("_seq", F.lit(1))
    _, late = ingest.merge_load(older.unionByName(older), table_dir, ["order_id"], "day-2")
    counts = {"first_emitted": F.lit(first).cast("bigint"),
              "late_emitted": F.lit(late).cast("bigint")}
    return store.read_current(spark, table_dir).select(*columns, "_seq").withColumns(counts)


def load_merge_touched_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders of the last order day come in a second batch, some
    new and some changed; ``carried`` says whether the new version refers to
    the very folders of all buckets that no key of the batch falls into."""
    cfg = run_config(spark, "load_merge_touched_buckets")
    orders = raw_tables(spark, sf_dir)["orders"]
    table_dir = cfg.dataset_dir("raw", "bucketed_orders")
    last = orders.agg(F.max("order_date")).first()[0]
    new = (F.col("order_date") == last) & (F.col("order_id") % 2 == 0)
    before = orders.where(~new | new.isNull()).withColumn(
        "order_status", F.when(F.col("order_date") == last, F.lit(9).cast("bigint")).otherwise(F.col("order_status")))
    first, _ = ingest.merge_load(before, table_dir, ["order_id"], "day-1", buckets=64)
    batch = orders.where(F.col("order_date") == last)
    second, _ = ingest.merge_load(batch, table_dir, ["order_id"], "day-2")
    old, now = (store.folders(spark, table_dir, v) for v in (first, second))
    touched = {r[0] for r in batch.select(store.bucket_of(["order_id"], 64)).distinct().collect()}
    carried = all((old.get(b) == now[b]) != (b in touched) for b in now) and set(old) <= set(now)
    return store.read_current(spark, table_dir).drop(*ingest.TRACE).withColumn("carried", F.lit(carried))


def load_merge_conflict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads start from one version, each with half of the changed
    orders; the one that publishes second is refused and loads again."""
    cfg = run_config(spark, "load_merge_conflict")
    orders = raw_tables(spark, sf_dir)["orders"]
    table_dir = cfg.dataset_dir("raw", "contested_orders")
    changed = F.coalesce(F.col("order_date") >= F.lit(str(FIRST_LOAD_DAY)), F.lit(False))
    ingest.merge_load(orders.where(~changed), table_dir, ["order_id"], "day-1")
    base, _ = store.current(spark, table_dir)
    mine = orders.where(changed & (F.col("order_id") % 2 == 0))
    stored = store.read_current(spark, table_dir)
    stale = store.write_version(ingest.upsert(stored, ingest.add_lineage(mine, ["order_id"], "mine"), ["order_id"]), table_dir)
    ingest.merge_load(orders.where(changed & (F.col("order_id") % 2 == 1)), table_dir, ["order_id"], "theirs")
    refused = 0
    try:
        store.publish(spark, table_dir, stale, base)
    except store.Conflict:
        refused += 1
        ingest.merge_load(mine, table_dir, ["order_id"], "mine")
    return store.read_current(spark, table_dir).drop(*ingest.TRACE).withColumn("refused", F.lit(refused).cast("bigint"))


def load_replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All tables loaded twice under one load id: one log row and one
    version each, with the rows that the first run emitted."""
    cfg = run_config(spark, "load_replayed")
    src = raw_tables(spark, sf_dir)
    for _ in range(2):
        results = ingest.ingest(spark, src, cfg, load_id=FIXED_LOAD_ID)
    versions = spark.createDataFrame(
        [(r.table, store.current(spark, cfg.dataset_dir("raw", r.table))[0]) for r in results], "table_name string, versions bigint")
    log = ingest.read_load_log(spark, cfg).groupBy("table_name", "load_id").agg(
        F.count("*").alias("log_rows"), F.sum("emitted_rows").alias("emitted_rows"))
    return log.join(versions, "table_name")


def load_schema_widened(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second load brings long customer ids, a third one statuses as
    text; stored buckets keep their files, rows are read with the common types."""
    cfg = run_config(spark, "load_schema_widened")
    orders = raw_tables(spark, sf_dir)["orders"].select("order_id", "customer_id", "order_status")
    table_dir = cfg.dataset_dir("raw", "widened_orders")
    short = [F.col(c).cast("int").alias(c) for c in orders.columns]
    ingest.merge_load(orders.select(*short), table_dir, ["order_id"], "day-1")
    longer = F.when(F.col("order_id") % 3 == 0, F.col("customer_id") + 10_000_000_000).alias("customer_id")
    ingest.merge_load(orders.where("order_id % 3 = 0").select("order_id", longer, "order_status"), table_dir, ["order_id"], "day-2")
    text = F.concat(F.lit("S"), F.col("order_status")).alias("order_status")
    ingest.merge_load(orders.where("order_id % 3 = 1").select("order_id", "customer_id", text), table_dir, ["order_id"], "day-3")
    return store.read_current(spark, table_dir).drop(*ingest.TRACE)


def store_expired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four versions of the customers, the second of them pinned by a
    reader; expiry keeps it and the latest. One row per version: whether it is
    still there, and its rows; those left come from its own folders and carried-over ones."""
    cfg = run_config(spark, "store_expired")
    customers = raw_tables(spark, sf_dir)["customers"]
    table_dir = cfg.dataset_dir("raw", "expiring_customers")
    versions = []
    for k in range(4):
        batch = customers.withColumn("phone", F.lit(str(k))).where(F.lit(True) if k == 0 else F.col("customer_id") % 97 == k)
        versions.append(ingest.merge_load(batch, table_dir, ["customer_id"], f"day-{k}", buckets=32)[0])
    store.pin(spark, table_dir, versions[1])
    gone = store.expire(spark, table_dir, keep=1)
    rows = [(k, v not in gone) for k, v in enumerate(versions)]
    parts = [store.read_version(spark, table_dir, versions[k]).groupBy().agg(
        F.lit(k).cast("bigint").alias("version"), F.lit(True).alias("kept"), F.count("*").alias("n_rows"),
        F.count(F.when(F.col("phone") != "0", 1)).alias("changed")) for k, kept in rows if kept]
    parts += [spark.createDataFrame([(k, False, None, None) for k, kept in rows if not kept], "version bigint, kept boolean, n_rows bigint, changed bigint")]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def recon_checks_diverged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I9-I12 where counts differ: customers are loaded with those of ASIA
    sent twice, then those of EUROPE are deleted at the source; the other
    tables were not loaded at all."""
    cfg = run_config(spark, "recon_checks_diverged")
    src = dict(raw_tables(spark, sf_dir))
    customers = src["customers"]
    sent = customers.unionByName(customers.where("state = 'ASIA'"))
    results = ingest.ingest(spark, {**src, "customers": sent}, cfg, only=["customers"])
    now = {**src, "customers": customers.where("state <> 'EUROPE'")}
    return reconcile.reconcile(spark, now, cfg, results)


# --- build and suite (I15, D11) -----------------------------------------------------


def _ingested(spark: SparkSession, sf_dir: str, tag: str) -> tuple[Config, ingest.LoadedRaw]:
    cfg = run_config(spark, tag).with_fixture_calendar()
    loads = ingest.ingest(spark, raw_tables(spark, sf_dir), cfg)
    return cfg, ingest.LoadedRaw(spark, cfg, loads)


def build_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ingest, then the gated build with tests after each dataset."""
    cfg, raw = _ingested(spark, sf_dir, "build_report")
    return build(spark, raw, cfg).report(spark).drop("seconds")


def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every declared and singular test over the built tables."""
    cfg, raw = _ingested(spark, sf_dir, "dq_report")
    result = build(spark, raw, cfg, run_tests=False, gate=False)
    return quality.report_frame(spark, quality.run_suite(result.workspace))


def dq_report_singular(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The suite restricted to the business tests (``test_type:singular``)."""
    generic, singular = quality.select_kinds(["test_type:singular"])
    return quality.evaluate(workspace(spark, sf_dir), generic, singular)


def build_materialized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every dataset as the view or table it is declared to be."""
    cfg, raw = _ingested(spark, sf_dir, "build_materialized")
    return build(spark, raw, cfg, run_tests=False).report(spark).drop("seconds")


def build_selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I16: one layer and one dataset rebuilt, the rest read or resolved."""
    cfg, raw = _ingested(spark, sf_dir, "build_selected")
    result = build(spark, raw, cfg, select=["reporting", "dim_stores"], run_tests=False)
    return result.report(spark).drop("seconds")


def build_ci(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A CI run reads the same raw layer and writes under its own prefix."""
    cfg, _ = _ingested(spark, sf_dir, "build_ci")
    ci = cfg.for_ci()
    build(spark, ingest.LoadedRaw(spark, ci), ci, select=["dim_stores"])
    written = store.read_current(spark, ci.dataset_dir("marts", "dim_stores"))
    return written.withColumn("layer_folder", F.lit(ci.layer_dir("marts").rpartition("/")[2]))


def build_report_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A zip code that is no number breaks dim_customers; its report row
    says error, what reads it is skipped, everything else is built."""
    cfg = run_config(spark, "build_report_error").with_fixture_calendar()
    raw = dict(raw_tables(spark, sf_dir))
    bad = F.when(F.col("state") == "ASIA", "oops").otherwise(F.col("zip_code").cast("string"))
    raw["customers"] = raw["customers"].withColumn("zip_code", bad)
    chosen = ["dim_customers", "dim_stores", "dim_products", "dim_staffs", "dim_date",
              "fct_orders", "fct_stocks", "rpt_orders", "rpt_stocks"]
    return build(spark, raw, cfg, select=chosen, run_tests=False).report(spark).drop("seconds")


def gate_two_input_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line revenue off by 1.00 fails the test that reads both facts,
    so both fail and both reports that read them are skipped."""
    cfg = run_config(spark, "gate_two_input_test").with_fixture_calendar()
    off = (F.col("revenue") + 1).cast("decimal(18,2)")
    result = build(
        spark, raw_tables(spark, sf_dir), cfg, select=["marts", "reporting"], suite=[],
        singular=["assert_order_revenue_reconciliation"],
        adjust={"fct_order_items": lambda df: df.withColumn("revenue", off)},
    )
    return result.report(spark).drop("seconds")


# --- single operators on the whole fixture build (D1-D9) -----------------------------


def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1 on order_id of the order lines: orders with several lines."""
    return quality.unique(workspace(spark, sf_dir)["stg_order_items"], "order_id")


def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D2 on shipped_date: orders not shipped."""
    return quality.not_null(workspace(spark, sf_dir)["fct_orders"], "shipped_date")


def dq_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D3: order dates of the lines against the default 2016-2019 calendar."""
    default_calendar = calendar(spark, DEFAULT_CALENDAR_START, DEFAULT_CALENDAR_END)
    lines = workspace(spark, sf_dir)["fct_order_items"]
    return quality.relationships(lines, "order_date", default_calendar, "date_day")


def dq_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order status codes of orders that are no longer open."""
    return quality.accepted_values(
        workspace(spark, sf_dir)["fct_orders"], "order_status", (1, 2)
    )


def dq_accepted_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shipping days must be >= 0."""
    return quality.accepted_range(workspace(spark, sf_dir)["fct_orders"], "shipping_days", 0)


def dq_unique_combination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D6 on the source's (order, line number) pair."""
    line = TestData(spark, sf_dir).table("lineitem")
    return quality.unique_combination(line, ["l_orderkey", "l_linenumber"])


def dq_shipped_after_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.shipped_before_ordered(workspace(spark, sf_dir)["fct_orders"])


def _over_billed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The facts, with lines of 45 or more pieces billed 1.00 too much."""
    ws = workspace(spark, sf_dir)
    over = F.when(F.col("quantity") >= 45, 1).otherwise(0)
    lines = ws["fct_order_items"]
    return ws["fct_orders"], lines.withColumn(
        "revenue", (F.col("revenue") + over).cast("decimal(18,2)"))


def dq_revenue_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D8 on seeded violations."""
    return quality.revenue_reconciliation(*_over_billed(spark, sf_dir))


def dq_revenue_formula(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D9 on seeded violations."""
    return quality.revenue_formula(_over_billed(spark, sf_dir)[1])


# --- scalar functions (F1-F24) ---------------------------------------------------


def scalar_staging_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1, F4, F6, F7 on the raw staff table, raw text beside the result."""
    raw = raw_tables(spark, sf_dir)["staffs"]
    return raw.select(
        fn.to_long("staff_id").alias("staff_id"),
        F.col("email").alias("email_text"),
        fn.null_text("email").alias("email"),
        F.col("active").alias("active_code"),
        fn.flag_is_one("active").alias("active"),
        F.col("manager_id").alias("manager_text"),
        fn.safe_long(fn.null_text("manager_id")).alias("manager_id"),
    )


def scalar_surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F14 with and without NULL parts."""
    orders = workspace(spark, sf_dir)["stg_orders"]
    return orders.select(
        "order_id",
        fn.surrogate_key(["order_id"]).alias("order_key"),
        fn.surrogate_key(["order_id", "shipped_date"]).alias("shipment_key"),
    )


def scalar_status_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F11."""
    orders = workspace(spark, sf_dir)["stg_orders"]
    return orders.select(
        "order_id", "order_status", fn.status_label("order_status").alias("order_status_label")
    )


def scalar_delivery_delays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F12, F13, F20, F21."""
    o = workspace(spark, sf_dir)["stg_orders"]
    shipped = F.col("shipped_date")
    return o.select(
        "order_id",
        fn.day_diff("required_date", "order_date").alias("days_to_required"),
        fn.day_diff("shipped_date", "order_date").alias("shipping_days"),
        shipped.isNull().alias("is_not_shipped"),
        F.coalesce(shipped > F.col("required_date"), F.lit(False)).alias("is_late"),
    )


def scalar_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F15-F19 on every order date."""
    o = workspace(spark, sf_dir)["stg_orders"]
    return o.select("order_id", F.col("order_date").alias("date_day")).select(
        "order_id", "date_day", *calendar_columns("date_day")
    )


def scalar_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line revenue and stock value."""
    lines = workspace(spark, sf_dir)["order_lines"]
    return lines.select("order_id", "item_id", "quantity", "list_price", "discount", "revenue")


def scalar_revenue_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices of three decimals and rates of five, as text at the
    source, are rounded once, after the product."""
    line = TestData(spark, sf_dir).table("lineitem")
    cents = F.lpad((F.col("l_partkey") * 7 % 1000).cast("string"), 3, "0")
    price = F.concat(F.floor("l_extendedprice").cast("string"), F.lit("."), cents)
    rate = F.concat(F.lit("0."), F.lpad((F.col("l_suppkey") * 7919 % 100000).cast("string"), 5, "0"))
    typed = line.select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_number"),
        fn.to_long("l_quantity").alias("quantity"), fn.to_price(price).alias("list_price"),
        fn.to_rate(rate).alias("discount"),
    )
    return typed.select("order_id", "line_number", fn.line_revenue().alias("revenue"))


# SQL a dashboard sends to the reporting tables, run unchanged by spark.sql
# over the registered views (and by DuckDB in the oracle).
DASHBOARD_SQL = """
select r.order_year_month, r.store_state, s.brand_name, s.order_status,
       cast(sum(s.revenue) as decimal(38,2)) as revenue,
       cast(count(distinct s.order_id) as bigint) as n_orders,
       cast(sum(case when r.is_late then 1 else 0 end) as bigint) as n_late_lines
from rpt_sales s
join rpt_orders r on s.order_id = r.order_id
group by r.order_year_month, r.store_state, s.brand_name, s.order_status
"""


def sql_dashboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL over the reporting tables registered as views."""
    from cadence.plans.sql import run_sql

    return run_sql(workspace(spark, sf_dir), DASHBOARD_SQL, ["rpt_sales", "rpt_orders"])


def co_located_workspace(spark: SparkSession, sf_dir: str, tag: str) -> Workspace:
    """Orders and their lines in the same buckets of the order key."""
    ws = workspace(spark, sf_dir)
    root = f"{run_config(spark, tag).root.rstrip('/')}/bucketed"
    frames = {name: ws[name] for name in ("stg_orders", "order_lines")}
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for name, df in bucketed.co_located(frames, root, "order_id", buckets).items():
        ws.put(name, df)
    return ws


def fct_orders_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line totals and their join with the headers, bucket by bucket."""
    return co_located_workspace(spark, sf_dir, "fct-orders")["fct_orders"]


def fct_order_items_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines and headers joined bucket by bucket."""
    return co_located_workspace(spark, sf_dir, "fct-order-items")["fct_order_items"]


def kpi_from_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1-K9, K18 from the stored rollup of the lines."""
    table = run_config(spark, "kpi-rollup").dataset_dir("reporting", "rpt_sales_rollup")
    # Two grains: a task writes two files at most, without dealing the rows once more.
    stored = store.write_and_publish(
        rollup.sales_rollup(workspace(spark, sf_dir)["rpt_sales"]), table, [rollup.GRAIN], dealt=True)
    return rollup.report(stored)


OPERATOR_QUERIES: dict[str, QueryFn] = {
    "kpi_from_rollup": kpi_from_rollup,
    "fct_orders_bucketed": fct_orders_bucketed,
    "fct_order_items_bucketed": fct_order_items_bucketed,
    "load_replace": load_replace,
    "load_merge_single_pk": load_merge_single_pk,
    "load_merge_composite_pk": load_merge_composite_pk,
    "load_lineage": load_lineage,
    "load_schema_evolution": load_schema_evolution,
    "load_merge_stream": load_merge_stream,
    "load_log": load_log,
    "recon_source_counts": recon_source_counts,
    "recon_checks": recon_checks,
    "build_report": build_report,
    "dq_unique": dq_unique,
    "dq_not_null": dq_not_null,
    "dq_relationships": dq_relationships,
    "dq_accepted_values": dq_accepted_values,
    "dq_accepted_range": dq_accepted_range,
    "dq_unique_combination": dq_unique_combination,
    "dq_shipped_after_order": dq_shipped_after_order,
    "dq_revenue_reconciliation": dq_revenue_reconciliation,
    "dq_revenue_formula": dq_revenue_formula,
    "dq_report": dq_report,
    "scalar_staging_casts": scalar_staging_casts,
    "scalar_surrogate_key": scalar_surrogate_key,
    "scalar_status_label": scalar_status_label,
    "scalar_delivery_delays": scalar_delivery_delays,
    "scalar_calendar": scalar_calendar,
    "scalar_revenue": scalar_revenue,
    "sql_dashboard": sql_dashboard,
    "load_selected": load_selected,
    "load_merge_null_key": load_merge_null_key,
    "load_merge_late_rows": load_merge_late_rows,
    "load_merge_touched_buckets": load_merge_touched_buckets,
    "load_merge_conflict": load_merge_conflict,
    "load_replayed": load_replayed,
    "load_schema_widened": load_schema_widened,
    "store_expired": store_expired,
    "recon_checks_diverged": recon_checks_diverged,
    "dq_report_singular": dq_report_singular,
    "build_materialized": build_materialized,
    "build_selected": build_selected,
    "build_ci": build_ci,
    "build_report_error": build_report_error,
    "gate_two_input_test": gate_two_input_test,
    "scalar_revenue_exact": scalar_revenue_exact,
    "dim_date": dim_date,
}


def all_queries() -> dict[str, QueryFn]:
    out: dict[str, QueryFn] = {name: _dataset_query(name) for name in DATASET_QUERIES}
    out.update(KPI_QUERIES)
    out.update(OPERATOR_QUERIES)
    return out
