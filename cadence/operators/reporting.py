"""Flat reporting tables, one per analysis axis.

Each is a fact with its dimensions left-joined. The calendar is broadcast
(its size is the configured day count); customer, product and staff
dimensions grow with the data and are left to the planner, which broadcasts
them only under the size threshold and otherwise shuffles (sort-merge join,
skewed partitions split by AQE).

The monthly tables are made in two halves: the rows with what the large
dimensions add, then the text of stores and dates, which are small and
broadcast. A build deals the rows to their months between the two, by the
month of the order date, so that this text is not shuffled. Sales lines are
dealt to their months by the very shuffle in which they meet their orders.
Columns that follow from others of the row (keys, revenue) are in no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType
from pyspark.sql.window import Window

from cadence.functions.columns import known_packed, known_unpacked, line_revenue, status_label, surrogate_key
from cadence.operators.marts import delivery_columns
from cadence.operators.numbering import STRETCH_BITS
from cadence.plans.concurrent import shuffles_released
from cadence.plans.datasets import TABLE, Env, dataset
from cadence.plans.joins import lookup_join


def _store_cols(dim_stores: DataFrame) -> DataFrame:
    return dim_stores.select(
        "store_id",
        "store_name",
        F.col("city").alias("store_city"),
        F.col("state").alias("store_state"),
    )


def _customer_cols(dim_customers: DataFrame) -> DataFrame:
    return dim_customers.select(
        "customer_id",
        F.col("full_name").alias("customer_name"),
        F.col("city").alias("customer_city"),
        F.col("state").alias("customer_state"),
    )


def _staff_cols(dim_staffs: DataFrame) -> DataFrame:
    return dim_staffs.select("staff_id", F.col("full_name").alias("staff_name"))


# Month of the order date: what rows are dealt by before a write.
MONTH = "_month"


def _dealing_month() -> Column:
    return F.trunc("order_date", "month").alias(MONTH)


def _sales_products(dim_products: DataFrame) -> DataFrame:
    return dim_products.select(
        "product_id", "product_name", "brand_name", "category_name", "model_year"
    )


# What the lines of an order repeat of it.
HEADER = ("customer_id", "store_id", "staff_id", "order_date", "order_status")


def _order_text(fct_order_items: DataFrame, dim_customers: DataFrame, dim_staffs: DataFrame,
                header: Sequence[str] = ()) -> DataFrame:
    """Customer and staff text per order, from the orders that the lines name; ``header``
    columns stay."""
    keys = dict.fromkeys(["order_id", "customer_id", "store_id", "staff_id", "order_date", *header])
    orders = fct_order_items.select(*keys).distinct()
    orders = orders.join(_customer_cols(dim_customers), "customer_id", "left")
    orders = orders.join(_staff_cols(dim_staffs), "staff_id", "left")
    return orders.drop(*[c for c in keys if c != "order_id" and c not in header])


def _one_header_each(fct_order_items: DataFrame) -> bool:
    """Whether all lines of an order repeat the same header. Runs a job."""
    headers = fct_order_items.where(F.col("order_id").isNotNull()).select("order_id", *HEADER).distinct()
    with shuffles_released(fct_order_items.sparkSession):
        most = headers.groupBy("order_id").agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n")).first()[0]
    return (most or 0) <= 1


LINE_KEY = ("order_id", "item_id")


def _revenue_of(revenue: DataType) -> Column:
    return line_revenue().try_cast(revenue)


def _sales_lines(fct_order_items: DataFrame, whole: bool) -> DataFrame:
    """Lines whose key is packed, and their revenue where they are read whole."""
    lines = fct_order_items.select(
        *[c for c in fct_order_items.columns if c != "order_item_key"],
        known_packed("order_item_key", surrogate_key(LINE_KEY)))
    if not whole:
        return lines
    revenue = known_packed("revenue", _revenue_of(fct_order_items.schema["revenue"].dataType))
    return lines.select(*[c for c in lines.columns if c != "revenue"], revenue)


def _sales_revenue(rows: DataFrame) -> Column:
    if "revenue" in rows.columns:
        return F.col("revenue")
    return known_unpacked("revenue", _revenue_of(rows.schema["_revenue_other"].dataType["value"].dataType))


def sales_rows(env: Env, fct_order_items: DataFrame, dim_products: DataFrame, dim_customers: DataFrame,
               dim_staffs: DataFrame) -> DataFrame:
    """Lines with the text of their customer, staff member and product; packed."""
    # Customer and staff belong to the order: they are joined once per order, and
    # the lines join the result on the key they are shuffled on. Stores and
    # dates come last: where they are broadcast, their text is in no shuffle.
    orders = _order_text(fct_order_items, dim_customers, dim_staffs)
    flat = _sales_lines(fct_order_items, env.whole).join(orders, "order_id", "left")
    return flat.join(_sales_products(dim_products), "product_id", "left")


# What sales lines and their orders are dealt by: the month, and a part of it.
DEAL = "_deal"
# Deals per shuffle partition: a month has as many parts as its share of the lines asks for.
DEALS_PER_PARTITION = 2
# Months of the years 1 to 9999, and none.
MOST_MONTHS = 12 * 9999 + 1


def _month_number() -> Column:
    return F.coalesce(F.year("order_date") * 12 + F.month("order_date"), F.lit(0))


def _deals(fct_order_items: DataFrame, env: Env) -> DataFrame:
    """Month and its number of parts: one row per month that has lines."""
    wanted = DEALS_PER_PARTITION * int(env.spark.conf.get("spark.sql.shuffle.partitions"))
    lines = fct_order_items.groupBy(_month_number().alias("_month")).agg(F.count(F.lit(1)).alias("_n"))
    share = F.col("_n") / F.sum("_n").over(Window.partitionBy())
    return lines.select("_month", F.greatest(F.ceil(share * wanted), F.lit(1)).cast("bigint").alias("_parts"))


def dealt_sales_rows(env: Env, fct_order_items: DataFrame, dim_products: DataFrame, dim_customers: DataFrame,
                     dim_staffs: DataFrame) -> DataFrame:
    """The rows of ``sales_rows``, dealt to parts of their months where lines and orders meet.

    Products are joined before, as their text is shorter than an order's. Lines of
    an order lie in stretches of their numbers, so that no order is one task's, and
    each deal that has lines of an order gets the order's text. Lines of no order
    are spread by their number. The header that the lines of an order repeat comes
    with its text, not through the lines' shuffles, where each order has just one."""
    lines = lookup_join(fct_order_items.withColumn("_month", _month_number()), _deals(fct_order_items, env),
                        "_month", known_rows=MOST_MONTHS)
    spread = F.xxhash64(F.coalesce("order_id", "item_id"), F.shiftright("item_id", STRETCH_BITS))
    deal = F.shiftleft(F.col("_month").cast("bigint"), 32) + F.pmod(spread, F.col("_parts"))
    lines = lines.withColumn(DEAL, deal).drop("_month", "_parts")
    header = HEADER if _one_header_each(fct_order_items) else ()
    if header:
        orders = _order_text(lines, dim_customers, dim_staffs, (DEAL, *header))
    else:
        orders = lines.select("order_id", DEAL).distinct().join(
            _order_text(fct_order_items, dim_customers, dim_staffs), "order_id", "left")
    flat = _sales_lines(lines, whole=True)
    if header:  # a line of no order keeps its own
        own = F.when(F.col("order_id").isNull(), F.struct(*header)).alias("_own")
        flat = flat.select(*[c for c in flat.columns if c not in header], own)
    flat = flat.join(_sales_products(dim_products), "product_id", "left")
    flat = _met_in_deals(flat, orders.where(F.col("order_id").isNotNull()))
    return flat.withColumns({c: F.coalesce(c, f"_own.{c}") for c in header}).drop("_own") if header else flat


def _met_in_deals(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """``lines`` left joined with ``orders`` on the order and the deal, dealt by the deal
    alone. A join would be dealt by both; here the two go through one shuffle and
    each line takes the texts of its order within its deal."""
    text = [c for c in orders.columns if c not in ("order_id", DEAL)]
    orders = orders.select("order_id", DEAL, F.struct(*text).alias("_text"))
    both = lines.withColumn("_line", F.lit(True)).unionByName(orders, allowMissingColumns=True).repartition(DEAL)
    texts = F.collect_list("_text").over(Window.partitionBy(DEAL, "order_id"))
    met = both.drop("_text").columns
    # One copy of the line for each text, the line alone where there is none.
    rows = both.withColumn("_texts", texts).where("_line").select(*met, F.explode_outer("_texts").alias("_text"))
    return rows.select(*lines.columns, *[F.col(f"_text.{c}").alias(c) for c in text])


def sales_text(rows: DataFrame, env: Env, dim_stores: DataFrame, dim_date: DataFrame) -> DataFrame:
    """The whole of ``rpt_sales`` from its rows: store and date text, labels."""
    dates = dim_date.select(
        F.col("date_day").alias("order_date"),
        F.col("year").alias("order_year"),
        F.col("quarter").alias("order_quarter"),
        F.col("month").alias("order_month"),
        F.col("month_name").alias("order_month_name"),
        F.col("year_month").alias("order_year_month"),
        F.col("day_name").alias("order_day_name"),
        F.col("is_weekend").alias("order_is_weekend"),
    )
    flat = rows.join(_store_cols(dim_stores), "store_id", "left")
    flat = lookup_join(flat, dates, "order_date", known_rows=env.cfg.calendar_days)
    return flat.select(
        known_unpacked("order_item_key", surrogate_key(LINE_KEY)),
        "order_id",
        "item_id",
        "order_date",
        "order_year",
        "order_quarter",
        "order_month",
        "order_month_name",
        "order_year_month",
        "order_day_name",
        "order_is_weekend",
        "order_status",
        status_label("order_status").alias("order_status_label"),
        "product_id",
        "product_name",
        "brand_name",
        "category_name",
        "model_year",
        "store_id",
        "store_name",
        "store_city",
        "store_state",
        "customer_id",
        "customer_name",
        "customer_city",
        "customer_state",
        "staff_id",
        "staff_name",
        "quantity",
        F.col("list_price").alias("unit_price"),
        "discount",
        _sales_revenue(rows),
    )


@dataset(
    "rpt_sales",
    "reporting",
    ["fct_order_items", "dim_products", "dim_stores", "dim_customers", "dim_staffs", "dim_date"],
    ["order_id", "item_id"],
    TABLE,
    partition_by=["order_year_month"],
    halves=(dealt_sales_rows, sales_text, DEAL),
    dealt=True,
)
def rpt_sales(
    env: Env,
    fct_order_items: DataFrame,
    dim_products: DataFrame,
    dim_stores: DataFrame,
    dim_customers: DataFrame,
    dim_staffs: DataFrame,
    dim_date: DataFrame,
) -> DataFrame:
    rows = sales_rows(env, fct_order_items, dim_products, dim_customers, dim_staffs)
    return sales_text(rows, env, dim_stores, dim_date)


def _delivery_of(types: dict[str, DataType]) -> dict[str, Column]:
    """What follows from status and dates, of the columns and in the types given."""
    return {c: e.try_cast(types[c]) for c, e in delivery_columns().items() if c in types}


def order_rows(env: Env, fct_orders: DataFrame, dim_customers: DataFrame, dim_staffs: DataFrame) -> DataFrame:
    """Orders with the text of their customer and staff member; packed where they are read whole."""
    if env.whole:
        known = _delivery_of({f.name: f.dataType for f in fct_orders.schema})
        packed = [known_packed(c, expected) for c, expected in known.items()]
        fct_orders = fct_orders.select(*[c for c in fct_orders.columns if c not in known], *packed)
    flat = fct_orders.join(_customer_cols(dim_customers), "customer_id", "left")
    flat = flat.join(_staff_cols(dim_staffs), "staff_id", "left")
    return flat.withColumn(MONTH, _dealing_month())


def order_text(rows: DataFrame, env: Env, dim_stores: DataFrame, dim_date: DataFrame) -> DataFrame:
    """The whole of ``rpt_orders`` from its rows: store and date text."""
    dates = dim_date.select(
        F.col("date_day").alias("order_date"),
        F.col("year").alias("order_year"),
        F.col("quarter").alias("order_quarter"),
        F.col("month").alias("order_month"),
        F.col("year_month").alias("order_year_month"),
    )
    flat = rows.join(_store_cols(dim_stores), "store_id", "left")
    flat = lookup_join(flat, dates, "order_date", known_rows=env.cfg.calendar_days)
    packed = {f.name[1:-len("_other")]: f.dataType["value"].dataType for f in rows.schema if f.name.endswith("_other")}
    flat = flat.withColumns({c: known_unpacked(c, e) for c, e in _delivery_of(packed).items()})
    return flat.select(
        "order_id",
        "order_date",
        "order_year",
        "order_quarter",
        "order_month",
        "order_year_month",
        "required_date",
        "shipped_date",
        "order_status",
        "order_status_label",
        "days_to_required",
        "shipping_days",
        "is_not_shipped",
        "is_late",
        "store_id",
        "store_name",
        "store_city",
        "store_state",
        "customer_id",
        "customer_name",
        "customer_city",
        "customer_state",
        "staff_id",
        "staff_name",
        "n_items",
        "total_quantity",
        "total_revenue",
    )


@dataset(
    "rpt_orders",
    "reporting",
    ["fct_orders", "dim_stores", "dim_customers", "dim_staffs", "dim_date"],
    ["order_id"],
    TABLE,
    partition_by=["order_year_month"],
    halves=(order_rows, order_text, MONTH),
)
def rpt_orders(
    env: Env,
    fct_orders: DataFrame,
    dim_stores: DataFrame,
    dim_customers: DataFrame,
    dim_staffs: DataFrame,
    dim_date: DataFrame,
) -> DataFrame:
    rows = order_rows(env, fct_orders, dim_customers, dim_staffs)
    return order_text(rows, env, dim_stores, dim_date)


@dataset(
    "rpt_stocks",
    "reporting",
    ["fct_stocks", "dim_stores", "dim_products"],
    ["store_id", "product_id"],
    TABLE,
)
def rpt_stocks(fct_stocks: DataFrame, dim_stores: DataFrame, dim_products: DataFrame) -> DataFrame:
    products = dim_products.select(
        "product_id", "product_name", "brand_name", "category_name", "model_year", "list_price"
    )
    # Stores last: where they are broadcast, their text is in no shuffle.
    key = surrogate_key(["store_id", "product_id"])
    flat = fct_stocks.select(*[c for c in fct_stocks.columns if c != "stock_key"], known_packed("stock_key", key))
    flat = flat.join(products, "product_id", "left")
    flat = flat.join(_store_cols(dim_stores), "store_id", "left")
    return flat.select(
        known_unpacked("stock_key", key),
        "store_id",
        "store_name",
        "store_city",
        "store_state",
        "product_id",
        "product_name",
        "brand_name",
        "category_name",
        "model_year",
        "list_price",
        "quantity",
        "stock_value",
        "is_out_of_stock",
    )
