"""Column expressions shared by every layer.

All of them are built-in Spark expressions: they stay inside whole-stage
codegen, there is no Python UDF anywhere.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that results depend on.
# Text that stands for a missing value in the source tables.
NULL_TEXT = "NULL"
# Order status codes and their labels; any other code, NULL included, is 'Unknown'.
STATUS_LABELS = {1: "Pending", 2: "Processing", 3: "Rejected", 4: "Completed"}
UNKNOWN_STATUS = "Unknown"
# Placeholder for NULL parts of a surrogate key, and the separator between parts.
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"
SURROGATE_SEPARATOR = "-"
# Decimal types: prices and discount rates keep the source's digits until the
# one final rounding; quantity x price x (1 - rate) then needs 38 digits, 14 of
# them decimals, and is exact. Money per line, and summed over many rows.
PRICE = "decimal(16,6)"
RATE = "decimal(9,8)"
COUNT = "decimal(10,0)"
MONEY = "decimal(18,2)"
MONEY_TOTAL = "decimal(38,2)"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_long(c: str | Column) -> Column:
    """Hard cast to int64 (F1): a malformed value fails the job (ANSI)."""
    return _col(c).cast("bigint")


def to_price(c: str | Column) -> Column:
    """Hard cast to an exact decimal (F2), not rounded to cents."""
    return _col(c).cast(PRICE)


def to_rate(c: str | Column) -> Column:
    return _col(c).cast(RATE)


def safe_date(c: str | Column) -> Column:
    """Soft cast to date (F3): 'NULL' or '2016-13-45' become NULL."""
    return _col(c).try_cast("date")


def safe_long(c: str | Column) -> Column:
    """Soft cast to int64."""
    return _col(c).try_cast("bigint")


def null_text(c: str | Column) -> Column:
    """``nullif(c, 'NULL')``."""
    return F.nullif(_col(c), F.lit(NULL_TEXT))


def flag_is_one(c: str | Column) -> Column:
    """int -> boolean by ``= 1``."""
    return to_long(c) == F.lit(1)


def full_name(first: str | Column, last: str | Column) -> Column:
    """``concat(first, ' ', last)``; NULL when a part is NULL."""
    return F.concat(_col(first), F.lit(" "), _col(last))


def status_label(c: str | Column) -> Column:
    """Simple CASE over the status code, 'Unknown' otherwise."""
    code = _col(c)
    expr = None
    for value, label in STATUS_LABELS.items():
        expr = (F.when if expr is None else expr.when)(code == value, F.lit(label))
    return expr.otherwise(F.lit(UNKNOWN_STATUS))


def day_diff(end: str | Column, start: str | Column) -> Column:
    """Whole days from ``start`` to ``end`` as int64."""
    return F.datediff(_col(end), _col(start)).cast("bigint")


def surrogate_key(cols: Sequence[str | Column]) -> Column:
    """Hash key over a column list (F14): md5 of the parts joined by '-',
    each part cast to string and NULL replaced by a fixed placeholder."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit(SURROGATE_NULL)) for c in cols]
    return F.md5(F.concat_ws(SURROGATE_SEPARATOR, *parts))


def hex_packed(column: str) -> list[Column]:
    """A key in hexadecimal text as two columns for a shuffle: its bytes, half as
    long, and any text that is not the hexadecimal form of bytes as it is."""
    c = F.col(column)
    same = F.coalesce(F.lower(F.hex(F.unhex(c))) == c, F.lit(False))
    return [F.when(same, F.unhex(c)).alias(f"_{column}_bytes"), F.when(~same, c).alias(f"_{column}_text")]


def hex_unpacked(column: str) -> Column:
    """The text that ``hex_packed`` was given."""
    return F.coalesce(F.lower(F.hex(f"_{column}_bytes")), f"_{column}_text").alias(column)


def known_packed(column: str, expected: Column) -> Column:
    """A column that follows from others of its row, for a shuffle: NULL where it has
    the ``expected`` value, else a struct of its ``value``."""
    differs = ~F.col(column).eqNullSafe(expected)
    return F.when(differs, F.struct(F.col(column).alias("value"))).alias(f"_{column}_other")


def known_unpacked(column: str, expected: Column) -> Column:
    """The column that ``known_packed`` was given, from the same ``expected``."""
    other = F.col(f"_{column}_other")
    return F.when(other.isNull(), expected).otherwise(other["value"]).alias(column)


def week_of_year_sunday(c: str | Column) -> Column:
    """Week number with weeks starting on Sunday; days before the year's
    first Sunday are week 0 (F17). Not ISO ``weekofyear``."""
    d = _col(c)
    return F.floor((F.dayofyear(d) + F.lit(7) - F.dayofweek(d)) / F.lit(7)).cast("bigint")


def line_revenue(
    quantity: str | Column = "quantity",
    list_price: str | Column = "list_price",
    discount: str | Column = "discount",
) -> Column:
    """``round(quantity * list_price * (1 - discount), 2)`` in exact decimals
    (F8, F9); HALF_UP rounding, then back to the money type."""
    off = F.lit(1).cast("decimal(1,0)") - _col(discount).cast(RATE)
    gross = _col(quantity).cast(COUNT) * _col(list_price).cast(PRICE) * off
    return F.round(gross, 2).cast(MONEY)


def money_sum(c: str | Column) -> Column:
    """Sum of money; wide enough for a whole fact table."""
    return F.sum(_col(c)).cast(MONEY_TOTAL)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient in double; NULL when the denominator is 0 or NULL."""
    return numerator.cast("double") / F.nullif(denominator, F.lit(0)).cast("double")


def bool_to_int(c: str | Column) -> Column:
    return _col(c).cast("int")
