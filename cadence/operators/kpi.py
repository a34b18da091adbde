"""Business questions on the reporting tables (K1-K19, SURVEY §2.10).

Every KPI is a ``groupBy().agg()``: partial aggregation runs before the
shuffle, so a hot store, state or customer costs one row per map task.
Filters (K19) are applied before aggregating; Catalyst pushes them to the
scans of the materialised reporting tables. Ratios are computed in double
from exact sums and counts; top-N uses ``orderBy(...).limit(n)``
(TakeOrderedAndProject: a bounded heap per task) with a key tie-break.

Choices where the questions leave one open are written next to each KPI.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cadence.functions.columns import MONEY_TOTAL, bool_to_int, money_sum, ratio

DEFAULT_TOP_N = 10
# Interactive filters the dashboard offers.
FILTER_COLUMNS = ("store_state", "brand_name", "is_out_of_stock")


def apply_filters(df: DataFrame, filters: dict | None) -> DataFrame:
    """Equality filters, a list means ``isin``. Unknown columns raise."""
    for column, value in (filters or {}).items():
        if column not in df.columns:
            raise ValueError(f"cannot filter on {column!r}: not a column of this table")
        if isinstance(value, (list, tuple, set)):
            df = df.where(F.col(column).isin(list(value)))
        else:
            df = df.where(F.col(column) == F.lit(value))
    return df


def _revenue() -> Column:
    return money_sum("revenue").alias("revenue")


def _n_orders() -> Column:
    return F.countDistinct("order_id").cast("bigint").alias("n_orders")


def _n_lines(sales: DataFrame) -> Column:
    """Lines; a rollup of them carries their number (``operators/rollup.py``)."""
    lines = F.sum("n_lines") if "n_lines" in sales.columns else F.count(F.lit(1))
    return lines.cast("bigint").alias("n_lines")


def _quantity() -> Column:
    return F.sum("quantity").cast("bigint").alias("total_quantity")


def _top(df: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """Top ``n`` by revenue, ties broken by ``keys``, ranked 1..n."""
    order = [F.col("revenue").desc()] + [F.col(k).asc_nulls_last() for k in keys]
    top = df.orderBy(*order).limit(n)
    # The window runs over at most n rows.
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast("bigint"))


# --- revenue axis (rpt_sales) -------------------------------------------------


def revenue_store_month(rpt_sales: DataFrame, filters: dict | None = None) -> DataFrame:
    """K1: revenue by store and year-month."""
    sales = apply_filters(rpt_sales, filters)
    return sales.groupBy("store_id", "store_name", "order_year_month").agg(
        _revenue(), _quantity(), _n_lines(sales)
    )


def revenue_state(rpt_sales: DataFrame, filters: dict | None = None) -> DataFrame:
    """K2: revenue by the store's state."""
    sales = apply_filters(rpt_sales, filters)
    return sales.groupBy("store_state").agg(_revenue(), _n_orders(), _n_lines(sales))


def revenue_period(rpt_sales: DataFrame, filters: dict | None = None) -> DataFrame:
    """K3: revenue time series by year, quarter and month."""
    sales = apply_filters(rpt_sales, filters)
    return sales.groupBy("order_year", "order_quarter", "order_month").agg(
        _revenue(), _n_orders(), _n_lines(sales)
    )


def top_products(rpt_sales: DataFrame, n: int = DEFAULT_TOP_N,
                 filters: dict | None = None) -> DataFrame:
    """K4: best products by revenue."""
    sales = apply_filters(rpt_sales, filters)
    per = sales.groupBy("product_id", "product_name").agg(_revenue(), _quantity())
    return _top(per, ["product_id"], n)


def top_categories(rpt_sales: DataFrame, n: int = DEFAULT_TOP_N,
                   filters: dict | None = None) -> DataFrame:
    """K5: best categories by revenue."""
    sales = apply_filters(rpt_sales, filters)
    per = sales.groupBy("category_name").agg(_revenue(), _quantity())
    return _top(per, ["category_name"], n)


def top_brands(rpt_sales: DataFrame, n: int = DEFAULT_TOP_N,
               filters: dict | None = None) -> DataFrame:
    """K6: best brands by revenue."""
    sales = apply_filters(rpt_sales, filters)
    per = sales.groupBy("brand_name").agg(_revenue(), _quantity())
    return _top(per, ["brand_name"], n)


def customer_value(rpt_sales: DataFrame, filters: dict | None = None) -> DataFrame:
    """K7: per customer, distinct orders, revenue and average basket
    (revenue / distinct orders). All customers with a sale; rank with
    ``top_customers``."""
    sales = apply_filters(rpt_sales, filters)
    per = sales.groupBy("customer_id", "customer_name").agg(_n_orders(), _revenue())
    return per.withColumn("avg_basket", ratio(F.col("revenue"), F.col("n_orders")))


def top_customers(rpt_sales: DataFrame, n: int = DEFAULT_TOP_N,
                  filters: dict | None = None) -> DataFrame:
    """K7, ranked: best customers by revenue."""
    return _top(customer_value(rpt_sales, filters), ["customer_id"], n)


def customer_geo(rpt_sales: DataFrame, filters: dict | None = None) -> DataFrame:
    """K8: customers, orders and revenue per customer state and city."""
    sales = apply_filters(rpt_sales, filters)
    return sales.groupBy("customer_state", "customer_city").agg(
        F.countDistinct("customer_id").cast("bigint").alias("n_customers"),
        _n_orders(),
        _revenue(),
    )


def sales_staff(rpt_sales: DataFrame, filters: dict | None = None) -> DataFrame:
    """K9: sales by staff member and store."""
    sales = apply_filters(rpt_sales, filters)
    return sales.groupBy("staff_id", "staff_name", "store_id", "store_name").agg(
        _revenue(), _n_orders(), _n_lines(sales), _quantity()
    )


def weekday_sales(rpt_sales: DataFrame, filters: dict | None = None) -> DataFrame:
    """Sales by day name, with the weekend flag."""
    sales = apply_filters(rpt_sales, filters)
    return sales.groupBy("order_is_weekend", "order_day_name").agg(
        _revenue(), _n_orders(), _n_lines(sales)
    )


# --- delivery axis (rpt_orders) -----------------------------------------------


def late_rate(rpt_orders: DataFrame, filters: dict | None = None) -> DataFrame:
    """Share of late orders per store; the denominator is every
    order of the store, shipped or not (an unshipped order is never late)."""
    orders = apply_filters(rpt_orders, filters)
    per = orders.groupBy("store_id", "store_name").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_orders"),
        F.sum(bool_to_int("is_late")).cast("bigint").alias("n_late"),
    )
    return per.withColumn("late_rate", ratio(F.col("n_late"), F.col("n_orders")))


def shipping_delay(rpt_orders: DataFrame, filters: dict | None = None) -> DataFrame:
    """Shipping days (shipped orders only) and days to required date
    per store."""
    orders = apply_filters(rpt_orders, filters)
    per = orders.groupBy("store_id", "store_name").agg(
        F.count("shipping_days").cast("bigint").alias("n_shipped"),
        F.sum("shipping_days").cast("bigint").alias("sum_shipping_days"),
        F.min("shipping_days").alias("min_shipping_days"),
        F.max("shipping_days").alias("max_shipping_days"),
        F.count("days_to_required").cast("bigint").alias("n_required"),
        F.sum("days_to_required").cast("bigint").alias("sum_days_to_required"),
    )
    return per.select(
        "store_id",
        "store_name",
        "n_shipped",
        ratio(F.col("sum_shipping_days"), F.col("n_shipped")).alias("avg_shipping_days"),
        "min_shipping_days",
        "max_shipping_days",
        ratio(F.col("sum_days_to_required"), F.col("n_required")).alias("avg_days_to_required"),
    )


def status_mix(rpt_orders: DataFrame, filters: dict | None = None) -> DataFrame:
    """Orders per status and their share of all orders."""
    orders = apply_filters(rpt_orders, filters)
    per = orders.groupBy("order_status", "order_status_label").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_orders")
    )
    # One row per status code: the window spans a handful of rows.
    total = F.sum("n_orders").over(Window.partitionBy())
    return per.withColumn("share", ratio(F.col("n_orders"), total))


def revenue_per_order(rpt_orders: DataFrame, filters: dict | None = None) -> DataFrame:
    """Orders, revenue and average revenue per order, by month."""
    orders = apply_filters(rpt_orders, filters)
    per = orders.groupBy("order_year_month").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_orders"),
        F.sum("total_revenue").cast(MONEY_TOTAL).alias("total_revenue"),
    )
    return per.withColumn(
        "avg_revenue_per_order", ratio(F.col("total_revenue"), F.col("n_orders"))
    )


def backlog(rpt_orders: DataFrame, filters: dict | None = None) -> DataFrame:
    """Unshipped orders and their revenue per store."""
    orders = apply_filters(rpt_orders, filters)
    open_revenue = F.when(F.col("is_not_shipped"), F.col("total_revenue"))
    return orders.groupBy("store_id", "store_name").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_orders"),
        F.sum(bool_to_int("is_not_shipped")).cast("bigint").alias("n_not_shipped"),
        F.coalesce(F.sum(open_revenue), F.lit(0)).cast(MONEY_TOTAL).alias("backlog_revenue"),
    )


# --- stock axis (rpt_stocks) --------------------------------------------------


def stock_store(rpt_stocks: DataFrame, filters: dict | None = None) -> DataFrame:
    """Stock level and value per store."""
    stocks = apply_filters(rpt_stocks, filters)
    return stocks.groupBy("store_id", "store_name").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_products"),
        F.sum("quantity").cast("bigint").alias("total_quantity"),
        F.sum("stock_value").cast(MONEY_TOTAL).alias("stock_value"),
    )


def stockout_rate(rpt_stocks: DataFrame, filters: dict | None = None) -> DataFrame:
    """Out-of-stock positions and their share per store."""
    stocks = apply_filters(rpt_stocks, filters)
    per = stocks.groupBy("store_id", "store_name").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_products"),
        F.sum(bool_to_int("is_out_of_stock")).cast("bigint").alias("n_out_of_stock"),
    )
    return per.withColumn("stockout_rate", ratio(F.col("n_out_of_stock"), F.col("n_products")))


def stockout_list(rpt_stocks: DataFrame, filters: dict | None = None) -> DataFrame:
    """The out-of-stock positions themselves."""
    stocks = apply_filters(rpt_stocks, filters)
    return stocks.where(F.col("is_out_of_stock")).select(
        "store_id", "store_name", "store_state", "product_id", "product_name",
        "brand_name", "category_name",
    )


def turnover(rpt_sales: DataFrame, rpt_stocks: DataFrame,
             filters: dict | None = None) -> DataFrame:
    """Units sold / units in stock per stock position (store x
    product); NULL when the position holds 0 units. Sales are aggregated to
    one row per position before the join."""
    sales = apply_filters(rpt_sales, {k: v for k, v in (filters or {}).items()
                                      if k in rpt_sales.columns})
    stocks = apply_filters(rpt_stocks, filters)
    sold = sales.groupBy("store_id", "product_id").agg(
        F.sum("quantity").cast("bigint").alias("units_sold")
    )
    joined = stocks.select("store_id", "product_id", "quantity").join(
        sold, ["store_id", "product_id"], "left"
    )
    units_sold = F.coalesce(F.col("units_sold"), F.lit(0).cast("bigint"))
    return joined.select(
        "store_id",
        "product_id",
        units_sold.alias("units_sold"),
        F.col("quantity").alias("units_in_stock"),
        ratio(units_sold, F.col("quantity")).alias("turnover"),
    )
