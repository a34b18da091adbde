"""The nine raw retail tables, derived from the driver's TPC-H-like tables.

This plays the operational database: ``raw_tables`` gives its current
state, ``snapshot`` its state on an earlier day (orders placed later do not
exist yet, shipments made later have not happened yet). Every expression is
a built-in Spark expression; the mapping is written out in FIXTURES.md §2.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadence.functions.columns import NULL_TEXT, PRICE, RATE
from cadence.operators.numbering import number_within_key
from cadence.sources.testdata import TestData

# Fixed values that results depend on: category codes by part type.
CATEGORY_CODES = {
    "ECONOMY": 1,
    "LARGE": 2,
    "MEDIUM": 3,
    "PROMO": 4,
    "SMALL": 5,
    "STANDARD": 6,
}
# Order status codes by TPC-H order status (O = open, P = partial, F = final).
STATUS_CODES = {"O": 1, "P": 2, "F": 4}
# Columns that order the lines of one order into item numbers 1, 2, ... The last
# tells no two rows of ``order_items`` apart that the others do not: it is not read there.
ITEM_ORDER = (
    "l_orderkey",
    "l_linenumber",
    "l_partkey",
    "l_suppkey",
    "l_extendedprice",
    "l_discount",
    "l_quantity",
    "l_shipdate",
)


def _code(col: str, codes: dict) -> F.Column:
    expr = None
    for key, value in codes.items():
        expr = (F.when if expr is None else expr.when)(F.col(col) == key, F.lit(value))
    return expr.cast("bigint")


def _text_or_null(is_null: F.Column, text: F.Column) -> F.Column:
    return F.when(is_null, F.lit(NULL_TEXT)).otherwise(text)


def _date_text(c: F.Column) -> F.Column:
    return c.cast("date").cast("string")


def brands(src: TestData) -> DataFrame:
    part = src.table("part")
    return part.select(
        F.substr(F.col("p_brand"), F.lit(7)).cast("bigint").alias("brand_id"),
        F.col("p_brand").alias("brand_name"),
    ).distinct()


def categories(src: TestData) -> DataFrame:
    part = src.table("part")
    return part.select(
        _code("p_type", CATEGORY_CODES).alias("category_id"),
        F.col("p_type").alias("category_name"),
    ).distinct()


def products(src: TestData) -> DataFrame:
    part = src.table("part")
    return part.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.substr(F.col("p_brand"), F.lit(7)).cast("bigint").alias("brand_id"),
        _code("p_type", CATEGORY_CODES).alias("category_id"),
        (F.lit(2016) + F.col("p_size") % 4).cast("bigint").alias("model_year"),
        F.col("p_retailprice").cast(PRICE).alias("list_price"),
    )


def stores(src: TestData) -> DataFrame:
    nation = src.table("nation")
    region = src.table("region")
    key = F.col("n_nationkey")
    return nation.join(region, nation.n_regionkey == region.r_regionkey, "inner").select(
        key.cast("bigint").alias("store_id"),
        F.col("n_name").alias("store_name"),
        _text_or_null(key % 4 == 0, F.concat(F.lit("555-"), key.cast("string"))).alias("phone"),
        _text_or_null(
            key % 5 == 0, F.concat(F.lit("store"), key.cast("string"), F.lit("@example.com"))
        ).alias("email"),
        F.concat(F.lit("Street "), key.cast("string")).alias("street"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("state"),
        (F.lit(10000) + key).cast("bigint").alias("zip_code"),
    )


def staffs(src: TestData) -> DataFrame:
    supplier = src.table("supplier")
    key = F.col("s_suppkey")
    return supplier.select(
        key.alias("staff_id"),
        F.lit("Supplier").alias("first_name"),
        F.substr(F.col("s_name"), F.lit(10)).alias("last_name"),
        _text_or_null(
            key % 5 == 0, F.concat(F.lit("staff"), key.cast("string"), F.lit("@example.com"))
        ).alias("email"),
        _text_or_null(key % 4 == 0, F.concat(F.lit("555-"), key.cast("string"))).alias("phone"),
        F.when(key % 7 == 0, F.lit(0)).otherwise(F.lit(1)).cast("bigint").alias("active"),
        F.col("s_nationkey").cast("bigint").alias("store_id"),
        _text_or_null(key < 3, (key % 3).cast("string")).alias("manager_id"),
    )


def customers(src: TestData) -> DataFrame:
    customer = src.table("customer")
    nation = src.table("nation")
    region = src.table("region")
    key = F.col("c_custkey")
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey, "inner").select(
        "n_nationkey", "n_name", "r_name"
    )
    return customer.join(geo, customer.c_nationkey == geo.n_nationkey, "inner").select(
        key.alias("customer_id"),
        F.lit("Customer").alias("first_name"),
        F.substr(F.col("c_name"), F.lit(10)).alias("last_name"),
        _text_or_null(key % 3 == 0, F.concat(F.lit("555-"), key.cast("string"))).alias("phone"),
        _text_or_null(
            key % 4 == 0, F.concat(F.lit("customer"), key.cast("string"), F.lit("@example.com"))
        ).alias("email"),
        F.concat(F.lit("Street "), key.cast("string")).alias("street"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("state"),
        (F.lit(20000) + F.col("c_nationkey")).cast("bigint").alias("zip_code"),
    )


def order_items(src: TestData) -> DataFrame:
    """Order lines; ``item_id`` numbers the lines of one order 1, 2, ...

    Numbered by ``number_within_key``, which splits an order of any size.
    """
    line = src.table("lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount",
    )
    numbered = number_within_key(line, "l_orderkey", ITEM_ORDER[1:-1], "item_id")
    return numbered.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        F.col("l_extendedprice").cast(PRICE).alias("list_price"),
        F.col("l_discount").cast(RATE).alias("discount"),
    )


def _order_line_summary(src: TestData) -> DataFrame:
    """Per order: last ship date and lowest supplier (partial + final agg)."""
    line = src.table("lineitem")
    return line.groupBy(F.col("l_orderkey").alias("order_key")).agg(
        F.max("l_shipdate").alias("last_ship"),
        F.min("l_suppkey").alias("first_supplier"),
    )


def orders(src: TestData) -> DataFrame:
    order = src.table("orders")
    supplier = src.table("supplier").select(
        F.col("s_suppkey").alias("first_supplier"), F.col("s_nationkey")
    )
    lines = _order_line_summary(src)
    joined = order.join(lines, order.o_orderkey == lines.order_key, "left").join(
        supplier, "first_supplier", "left"
    )
    order_day = F.col("o_orderdate").cast("date")
    not_shipped = (F.col("o_orderstatus") == "P") | F.col("last_ship").isNull()
    return joined.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        _code("o_orderstatus", STATUS_CODES).alias("order_status"),
        order_day.cast("string").alias("order_date"),
        F.date_add(order_day, (F.lit(1) + F.col("o_orderkey") % 5).cast("int"))
        .cast("string")
        .alias("required_date"),
        _text_or_null(not_shipped, _date_text(F.col("last_ship"))).alias("shipped_date"),
        F.col("s_nationkey").cast("bigint").alias("store_id"),
        F.col("first_supplier").alias("staff_id"),
    )


def stocks(src: TestData) -> DataFrame:
    """Stock snapshot per (store, product) a supplier has delivered.

    Lines are reduced to distinct (supplier, part) pairs before the join, so
    the join and the final distinct see pairs, not lines.
    """
    line = src.table("lineitem")
    supplier = src.table("supplier")
    pairs = line.select("l_suppkey", "l_partkey").distinct()
    located = pairs.join(supplier, pairs.l_suppkey == supplier.s_suppkey, "inner")
    store = F.col("s_nationkey").cast("bigint")
    product = F.col("l_partkey")
    return (
        located.select(store.alias("store_id"), product.alias("product_id"))
        .distinct()
        .withColumn("quantity", (F.col("store_id") * 7 + F.col("product_id")) % 13)
    )


RAW_BUILDERS = {
    "customers": customers,
    "orders": orders,
    "order_items": order_items,
    "staffs": staffs,
    "stores": stores,
    "categories": categories,
    "products": products,
    "stocks": stocks,
    "brands": brands,
}


class RawTables(Mapping):
    """The nine source tables, each built on first access."""

    def __init__(self, src: TestData):
        self.src = src
        self._frames: dict[str, DataFrame] = {}

    def __getitem__(self, table: str) -> DataFrame:
        if table not in self._frames:
            self._frames[table] = RAW_BUILDERS[table](self.src)
        return self._frames[table]

    def __iter__(self) -> Iterator[str]:
        return iter(RAW_BUILDERS)

    def __len__(self) -> int:
        return len(RAW_BUILDERS)


def raw_tables(spark: SparkSession, sf_dir: str) -> RawTables:
    """Current state of the nine source tables, keyed by table name."""
    return RawTables(TestData(spark, sf_dir))


def orders_as_of(src: TestData, day: dt.date) -> DataFrame:
    """Orders as the source held them at the end of ``day``: later orders
    do not exist, later shipments have not happened."""
    cutoff = F.lit(day)
    current = orders(src)
    shipped_later = F.col("shipped_date").try_cast("date") > cutoff
    return current.where(F.col("order_date").cast("date") <= cutoff).withColumn(
        "shipped_date", F.when(shipped_later, F.lit(NULL_TEXT)).otherwise(F.col("shipped_date"))
    )


def order_items_as_of(src: TestData, day: dt.date) -> DataFrame:
    """Lines of the orders placed up to ``day``."""
    placed = (
        src.table("orders")
        .where(F.col("o_orderdate").cast("date") <= F.lit(day))
        .select(F.col("o_orderkey").alias("order_id"))
    )
    return order_items(src).join(placed, "order_id", "left_semi")


def orders_changed_since(src: TestData, day: dt.date) -> DataFrame:
    """Incremental extract: orders placed or shipped after ``day``."""
    cutoff = F.lit(day)
    current = orders(src)
    return current.where(
        (F.col("order_date").cast("date") > cutoff)
        | (F.col("shipped_date").try_cast("date") > cutoff)
    )


def order_items_placed_after(src: TestData, day: dt.date) -> DataFrame:
    """Incremental extract: lines of the orders placed after ``day``."""
    placed = (
        src.table("orders")
        .where(F.col("o_orderdate").cast("date") > F.lit(day))
        .select(F.col("o_orderkey").alias("order_id"))
    )
    return order_items(src).join(placed, "order_id", "left_semi")
