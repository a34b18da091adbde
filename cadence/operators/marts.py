"""Intermediate enrichment, dimensions and facts (M1-M9).

Facts are built from ``order_lines`` (typed lines plus revenue), not from
the product-enriched view: the three product/brand/category joins add no
column a fact needs, and Catalyst cannot drop a left join without a declared
unique key. Results are equal as long as the dimension keys are unique,
which the suite checks (``unique`` on every dimension key).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadence.functions.calendar import calendar_columns
from cadence.functions.columns import (
    COUNT,
    MONEY,
    MONEY_TOTAL,
    day_diff,
    full_name,
    known_packed,
    known_unpacked,
    line_revenue,
    status_label,
    surrogate_key,
)
from cadence.plans.datasets import TABLE, Env, dataset


@dataset("order_lines", "intermediate", ["stg_order_items"], ["order_id", "item_id"])
def order_lines(stg_order_items: DataFrame) -> DataFrame:
    """Typed order lines with ``revenue``; no joins."""
    return stg_order_items.withColumn("revenue", line_revenue())


@dataset(
    "int_order_items_enriched",
    "intermediate",
    ["order_lines", "stg_products", "stg_brands", "stg_categories"],
    ["order_id", "item_id"],
)
def int_order_items_enriched(
    order_lines: DataFrame,
    stg_products: DataFrame,
    stg_brands: DataFrame,
    stg_categories: DataFrame,
) -> DataFrame:
    """Lines x product x brand x category (M1), three left joins."""
    product = stg_products.select(
        "product_id", "brand_id", "category_id", "product_name", "model_year"
    )
    enriched = (
        order_lines.join(product, "product_id", "left")
        .join(stg_brands, "brand_id", "left")
        .join(stg_categories, "category_id", "left")
    )
    return enriched.select(
        "order_id",
        "item_id",
        "product_id",
        "brand_id",
        "category_id",
        "product_name",
        "model_year",
        "brand_name",
        "category_name",
        "quantity",
        "list_price",
        "discount",
        "revenue",
    )


@dataset("dim_customers", "marts", ["stg_customers"], ["customer_id"], TABLE)
def dim_customers(stg_customers: DataFrame) -> DataFrame:
    return stg_customers.select(
        "customer_id",
        "first_name",
        "last_name",
        full_name("first_name", "last_name").alias("full_name"),
        "email",
        "phone",
        "street",
        "city",
        "state",
        "zip_code",
    )


@dataset("dim_stores", "marts", ["stg_stores"], ["store_id"], TABLE)
def dim_stores(stg_stores: DataFrame) -> DataFrame:
    return stg_stores.select(
        "store_id", "store_name", "phone", "email", "street", "city", "state", "zip_code"
    )


@dataset(
    "dim_products",
    "marts",
    ["stg_products", "stg_brands", "stg_categories"],
    ["product_id"],
    TABLE,
)
def dim_products(
    stg_products: DataFrame, stg_brands: DataFrame, stg_categories: DataFrame
) -> DataFrame:
    joined = stg_products.join(stg_brands, "brand_id", "left").join(
        stg_categories, "category_id", "left"
    )
    return joined.select(
        "product_id",
        "product_name",
        "model_year",
        "list_price",
        "brand_id",
        "brand_name",
        "category_id",
        "category_name",
    )


@dataset("dim_staffs", "marts", ["stg_staffs"], ["staff_id"], TABLE)
def dim_staffs(stg_staffs: DataFrame) -> DataFrame:
    """Staff with the manager's name, by a self left join."""
    staff = stg_staffs.alias("s")
    manager = stg_staffs.select(
        F.col("staff_id").alias("m_staff_id"),
        full_name("first_name", "last_name").alias("manager_name"),
    )
    joined = staff.join(manager, F.col("s.manager_id") == F.col("m_staff_id"), "left")
    return joined.select(
        F.col("s.staff_id").alias("staff_id"),
        F.col("s.first_name").alias("first_name"),
        F.col("s.last_name").alias("last_name"),
        full_name("s.first_name", "s.last_name").alias("full_name"),
        F.col("s.email").alias("email"),
        F.col("s.phone").alias("phone"),
        F.col("s.active").alias("active"),
        F.col("s.store_id").alias("store_id"),
        F.col("s.manager_id").alias("manager_id"),
        F.col("manager_name"),
    )


def calendar(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """One row per day from ``start`` (inclusive) to ``end`` (exclusive) with
    its attributes; the size is known on the driver: ``(end - start).days``."""
    days = spark.range(0, (end - start).days, numPartitions=1)
    spine = days.select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("date_day"))
    return spine.select("date_day", *calendar_columns("date_day"))


def order_calendar(stg_orders: DataFrame) -> DataFrame:
    """Calendar of the whole years in which orders were placed, from the
    orders themselves: their first and last day (one row) generate the days."""
    span = stg_orders.agg(F.min("order_date").alias("first"), F.max("order_date").alias("last"))
    day = F.make_interval(days=F.lit(1))
    days = F.sequence(
        F.trunc("first", "year"),
        F.date_sub(F.add_months(F.trunc("last", "year"), 12), 1), day)
    spine = span.select(F.explode(days).alias("date_day"))
    return spine.select("date_day", *calendar_columns("date_day"))


@dataset("dim_date", "marts", [], ["date_day"], TABLE)
def dim_date(env: Env) -> DataFrame:
    """Calendar over the configured range (M6)."""
    return calendar(env.spark, env.cfg.calendar_start, env.cfg.calendar_end)


@dataset(
    "fct_order_items",
    "marts",
    ["order_lines", "stg_orders"],
    ["order_id", "item_id"],
    TABLE,
)
def fct_order_items(order_lines: DataFrame, stg_orders: DataFrame, env: Env | None = None) -> DataFrame:
    """One row per order line with the header's keys (M7)."""
    header = stg_orders.select(
        "order_id", "customer_id", "store_id", "staff_id", "order_date", "order_status"
    )
    revenue = F.col("revenue")
    if env and env.whole:
        formula = line_revenue().try_cast(order_lines.schema["revenue"].dataType)
        order_lines = order_lines.select(
            *[c for c in order_lines.columns if c != "revenue"], known_packed("revenue", formula))
        revenue = known_unpacked("revenue", formula)
    joined = order_lines.join(header, "order_id", "left")
    return joined.select(
        surrogate_key(["order_id", "item_id"]).alias("order_item_key"),
        "order_id",
        "item_id",
        "product_id",
        "customer_id",
        "store_id",
        "staff_id",
        "order_date",
        "order_status",
        "quantity",
        "list_price",
        "discount",
        revenue,
    )


def lines_per_order(order_lines: DataFrame) -> DataFrame:
    """count / sum quantity / sum revenue per order (A1); partial
    aggregation runs before the shuffle, so a hot order costs one row per
    map task."""
    return order_lines.groupBy("order_id").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_items"),
        F.sum("quantity").cast("bigint").alias("total_quantity"),
        F.sum("revenue").cast(MONEY_TOTAL).alias("total_revenue"),
    )


def delivery_columns() -> dict[str, Column]:
    """What follows from an order's status and dates."""
    shipped = F.col("shipped_date")
    return {
        "order_status_label": status_label("order_status"),
        "days_to_required": day_diff("required_date", "order_date"),
        "shipping_days": day_diff("shipped_date", "order_date"),
        "is_not_shipped": shipped.isNull(),
        "is_late": F.coalesce(shipped > F.col("required_date"), F.lit(False)),
    }


@dataset("fct_orders", "marts", ["stg_orders", "order_lines"], ["order_id"], TABLE)
def fct_orders(stg_orders: DataFrame, order_lines: DataFrame) -> DataFrame:
    """Order header with delivery measures and line totals (M8)."""
    totals = lines_per_order(order_lines)
    joined = stg_orders.join(totals, "order_id", "left")
    delivery = {name: c.alias(name) for name, c in delivery_columns().items()}
    return joined.select(
        "order_id",
        "customer_id",
        "store_id",
        "staff_id",
        "order_date",
        "order_status",
        delivery["order_status_label"],
        "required_date",
        "shipped_date",
        delivery["days_to_required"],
        delivery["shipping_days"],
        delivery["is_not_shipped"],
        delivery["is_late"],
        F.coalesce("n_items", F.lit(0).cast("bigint")).alias("n_items"),
        F.coalesce("total_quantity", F.lit(0).cast("bigint")).alias("total_quantity"),
        F.coalesce("total_revenue", F.lit(0).cast(MONEY_TOTAL)).alias("total_revenue"),
    )


@dataset("fct_stocks", "marts", ["stg_stocks", "stg_products"], ["store_id", "product_id"], TABLE)
def fct_stocks(stg_stocks: DataFrame, stg_products: DataFrame) -> DataFrame:
    """Stock snapshot per store x product with its value (M9)."""
    price = stg_products.select("product_id", "list_price")
    joined = stg_stocks.join(price, "product_id", "left")
    return joined.select(
        surrogate_key(["store_id", "product_id"]).alias("stock_key"),
        "store_id",
        "product_id",
        "quantity",
        F.round(F.col("quantity").cast(COUNT) * F.col("list_price"), 2).cast(MONEY).alias(
            "stock_value"
        ),
        (F.col("quantity") == 0).alias("is_out_of_stock"),
    )
