"""Schema evolution (I7): the narrowest type that holds both, at merge and at read.

Types widen where every value stays exact: whole numbers to longer ones and
to decimals, decimals to more digits, float and short whole numbers to double,
dates to timestamps. A column whose new type has no such common type with the
old one keeps its old values; the new ones go to a column ``<name>__<type>``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Whole-number types from short to long, with the decimal digits of each.
WHOLE = {T.ByteType(): 3, T.ShortType(): 5, T.IntegerType(): 10, T.LongType(): 19}
_LENGTH = list(WHOLE)
MOST_DIGITS = 38


def _as_decimal(t: T.DataType) -> T.DecimalType | None:
    return t if isinstance(t, T.DecimalType) else T.DecimalType(WHOLE[t], 0) if t in WHOLE else None


def common_type(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The narrowest type that holds every value of both, or None."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if a in WHOLE and b in WHOLE:
        return max(a, b, key=_LENGTH.index)
    da, db = _as_decimal(a), _as_decimal(b)
    if da and db:
        scale = max(da.scale, db.scale)
        digits = max(da.precision - da.scale, db.precision - db.scale) + scale
        return T.DecimalType(digits, scale) if digits <= MOST_DIGITS else None
    pair = {type(a), type(b)}
    if T.DoubleType in pair and pair & {T.FloatType, T.ByteType, T.ShortType, T.IntegerType}:
        return T.DoubleType()
    for stamp in (T.TimestampType, T.TimestampNTZType):
        if pair == {T.DateType, stamp}:
            return stamp()
    return None


def merged_schema(stored: T.StructType, batch: T.StructType, key: Sequence[str] = ()) -> tuple[T.StructType, dict[str, str]]:
    """The schema that holds both, stored columns first, and the columns of the batch that get another name."""
    types = {f.name: f.dataType for f in stored.fields}
    renamed = {}
    for f in batch.fields:
        name = f.name
        if name in types and common_type(types[name], f.dataType) is None:
            if name in key:
                raise TypeError(f"key column {name}: {f.dataType.simpleString()} does not fit {types[name].simpleString()}")
            renamed[name] = name = f"{name}__{f.dataType.typeName()}"
            if name in types and common_type(types[name], f.dataType) is None:
                raise TypeError(f"column {f.name}: {f.dataType.simpleString()} fits neither it nor {name}")
        types[name] = common_type(types[name], f.dataType) if name in types else f.dataType
    return T.StructType([T.StructField(n, t) for n, t in types.items()]), renamed


def conform(df: DataFrame, schema: T.StructType, renamed: dict[str, str] | None = None) -> DataFrame:
    """``df`` with the columns and types of ``schema``; columns it lacks are NULL."""
    source = {(renamed or {}).get(c, c): c for c in df.columns}
    return df.select(*[(F.col(f"`{source[f.name]}`").cast(f.dataType) if f.name in source else F.lit(None).cast(f.dataType)).alias(f.name)
                       for f in schema.fields])


def whole_number(t: T.DataType) -> bool:
    return t in WHOLE
