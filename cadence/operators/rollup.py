"""Sales questions from one stored rollup.

The lines are read and aggregated once, over two grouping sets: per order with
its store, month, staff and customer, and per product with its brand and
category. Sums over either grain are those over the lines, and an order is one
row of the order grain, so distinct orders and customers are exact too. The
rollup is a table partitioned by grain; each question reads one grain of it,
many times smaller than the lines. A filter works where its column belongs to
the grain (the store's state per order, the brand per product); others raise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.functions.columns import MONEY_TOTAL, money_sum
from cadence.operators import kpi

GRAIN, ORDER, PRODUCT = "grain", "order", "product"
ORDER_COLUMNS = (
    "order_id",
    "order_year",
    "order_quarter",
    "order_month",
    "order_year_month",
    "order_day_name",
    "order_is_weekend",
    "store_id",
    "store_name",
    "store_state",
    "customer_id",
    "customer_name",
    "customer_city",
    "customer_state",
    "staff_id",
    "staff_name",
)
PRODUCT_COLUMNS = ("product_id", "product_name", "brand_name", "category_name")
MEASURES = ("revenue", "quantity", "n_lines")

# Question -> grain, KPI and the keys of its rows.
QUESTIONS = {
    "kpi_revenue_store_month": (ORDER, kpi.revenue_store_month, ("store_id", "store_name", "order_year_month")),
    "kpi_revenue_state": (ORDER, kpi.revenue_state, ("store_state",)),
    "kpi_revenue_period": (ORDER, kpi.revenue_period, ("order_year", "order_quarter", "order_month")),
    "kpi_customer_value": (ORDER, kpi.customer_value, ("customer_id", "customer_name")),
    "kpi_top_customers": (ORDER, kpi.top_customers, ("customer_id", "customer_name")),
    "kpi_customer_geo": (ORDER, kpi.customer_geo, ("customer_state", "customer_city")),
    "kpi_sales_staff": (ORDER, kpi.sales_staff, ("staff_id", "staff_name", "store_id", "store_name")),
    "kpi_weekday": (ORDER, kpi.weekday_sales, ("order_is_weekend", "order_day_name")),
    "kpi_top_products": (PRODUCT, kpi.top_products, ("product_id", "product_name")),
    "kpi_top_categories": (PRODUCT, kpi.top_categories, ("category_name",)),
    "kpi_top_brands": (PRODUCT, kpi.top_brands, ("brand_name",)),
}


def sales_rollup(rpt_sales: DataFrame) -> DataFrame:
    """Revenue, quantity and lines per order and per product, with ``grain``.

    One scan; rows are combined before the shuffle, so an order, store or
    product with a third of the lines costs one row per task. NULL attributes
    are values like any other."""
    by = [*ORDER_COLUMNS, *PRODUCT_COLUMNS]
    sets = [list(ORDER_COLUMNS), list(PRODUCT_COLUMNS)]
    summed = rpt_sales.groupingSets(sets, *by).agg(
        F.grouping("order_id").alias("_no_order"),
        money_sum("revenue").alias("revenue"),
        F.sum("quantity").cast("bigint").alias("quantity"),
        F.count(F.lit(1)).cast("bigint").alias("n_lines"),
    )
    grain = F.when(F.col("_no_order") == 0, ORDER).otherwise(PRODUCT)
    return summed.select(*by, *MEASURES, grain.alias(GRAIN))


def at_grain(rollup: DataFrame, grain: str) -> DataFrame:
    """The rows of one grain, with its own columns only."""
    own = ORDER_COLUMNS if grain == ORDER else PRODUCT_COLUMNS
    return rollup.where(F.col(GRAIN) == grain).select(*own, *MEASURES)


def answer(rollup: DataFrame, question: str, filters: dict | None = None) -> DataFrame:
    """One question of ``QUESTIONS``, as its KPI over the lines gives it."""
    grain, fn, _ = QUESTIONS[question]
    return fn(at_grain(rollup, grain), filters=filters)


def report(rollup: DataFrame) -> DataFrame:
    """All questions, one row per answer: the question, its keys joined by ``|``
    (NULL: empty), and its measures (NULL where it has none of that name)."""
    columns = {"revenue": MONEY_TOTAL, "n_orders": "bigint", "n_lines": "bigint", "total_quantity": "bigint",
               "n_customers": "bigint", "avg_basket": "double", "rank": "bigint"}
    out = None
    for question, (_, _, keys) in QUESTIONS.items():
        rows = answer(rollup, question)
        key = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
        part = rows.select(
            F.lit(question).alias("question"), key.alias("answer_key"),
            *[(F.col(c) if c in rows.columns else F.lit(None)).cast(t).alias(c) for c, t in columns.items()])
        out = part if out is None else out.unionByName(part)
    return out
