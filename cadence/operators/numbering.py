"""Row numbers within a key, in a given order, without a hot-key straggler.

``row_number() over (partition by key order by ...)`` puts every row of a key
in one task. Here a key's rows are cut into stretches of its order: a stretch
is a monotone function of the first order column, so all rows of one stretch
come before all rows of the next. Counts per stretch (partial aggregation
before the shuffle) and their running sum give each stretch its first number;
rows are numbered within their stretch. The rows are shuffled once: the join
with the first numbers uses the columns that the window is dealt by, and only
stretches that do not start at 1 take part in it. One plan for every size,
built-in expressions only, nothing runs before the caller's action.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType
from pyspark.sql.window import Window

# Bits of an integral order column that a stretch spans.
STRETCH_BITS = 12
# Columns that a stretch of a key is dealt by, none of them NULL, and the bit
# of ``_nulls`` that stands for a NULL key.
GROUP = ("_key", "_of", "_nulls")
KEY_NULL = 2


def stretch_of(column: str, kind: DataType) -> Column:
    """A monotone coarsening of an order column: high bits of a number, the
    month of a date, the hour of a timestamp, the first characters of a text."""
    c = F.col(column)
    name = kind.typeName()
    if name in ("byte", "short", "integer", "long"):
        return F.shiftright(c.cast("bigint"), STRETCH_BITS)
    if name in ("float", "double", "decimal"):
        return F.floor(c / (1 << STRETCH_BITS)).cast("double")
    if name == "date":
        return F.trunc(c, "month")
    if name.startswith("timestamp"):
        return F.date_trunc("hour", c)
    if name in ("string", "varchar", "char"):
        return F.substring(c, 1, 4)
    raise TypeError(f"no monotone coarsening for {column}: {name}")


def _no_null(c: Column, kind: str) -> Column:
    zero = "1970-01-01" if kind.startswith(("date", "timestamp")) else "0"
    return F.coalesce(c, F.lit(zero).cast(kind))


def _group(key: Column, stretch: Column, kinds: Sequence[str]) -> list[Column]:
    """``GROUP``: equal exactly where key and stretch are the same or both NULL."""
    nulls = key.isNull().cast("int") * KEY_NULL + stretch.isNull().cast("int")
    parts = [_no_null(c, kind) for c, kind in zip((key, stretch), kinds)]
    return [c.alias(name) for c, name in zip((*parts, nulls), GROUP)]


def number_within_key(df: DataFrame, key: str, order: Sequence[str], out: str) -> DataFrame:
    """``df`` plus ``out`` = 1, 2, ... within each ``key``, following ``order``
    (which should make the order total; NULLs first, as a window sorts them).

    Rows with a NULL key are one group. Rows that are equal in the first order
    column share a stretch, so it should be the one that tells most rows apart.
    """
    first = order[0]
    stretch = stretch_of(first, df.schema[first].dataType)
    before = (
        Window.partitionBy(key).orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = (
        df.select(key, stretch.alias("_stretch"))
        .groupBy(key, "_stretch")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(key, "_stretch", F.sum("_n").over(before).alias("_before"))
        .where(F.col("_before") > 0)
    )
    kinds = [starts.schema[c].dataType.simpleString() for c in (key, "_stretch")]
    # One row per stretch either way; the aggregation tells Catalyst, which then drops
    # the join, and the shuffle for it, from queries that do not read ``out``.
    starts = starts.select(*_group(F.col(key), F.col("_stretch"), kinds), "_before")
    starts = starts.groupBy(*GROUP).agg(F.max("_before").alias("_before"))
    # The key travels once: as ``_key``, NULL again at the end.
    dealt = df.select(*[c for c in df.columns if c != key], *_group(F.col(key), stretch, kinds))
    within = Window.partitionBy(*GROUP).orderBy(*[c for c in order if c != key])
    at = dealt.withColumn("_at", F.row_number().over(within))
    numbered = at.join(starts, list(GROUP), "left")
    whole = F.when(F.col("_nulls") < KEY_NULL, F.col("_key")).alias(key)
    return numbered.select(
        *[whole if c == key else F.col(c) for c in df.columns],
        (F.coalesce("_before", F.lit(0)) + F.col("_at")).cast("bigint").alias(out),
    )
