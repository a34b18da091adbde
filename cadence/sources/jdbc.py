"""Relational source scan (I1): one table of a schema, read in parallel.

Row count and bounds of the key columns come from one aggregate query pushed
to the database. Of the columns that can be split (numbers, dates,
timestamps) the one with the widest range is taken, and as many partitions as
the row count asks for. Numbers are split at equal depth: the database counts
the rows of even bins, bins with too many are counted again in finer ones, and
neighbouring bins make a range of about equal rows, so that gaps and dense
stretches of a key do not make uneven partitions. Dates and timestamps are
split in even steps. Text keys are split by the database's hash of them.
Credentials and SSL settings pass through as JDBC properties.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from cadence.catalog import select_tables

# Options every read carries (callers' properties take precedence).
DEFAULTS = {"pushDownAggregate": "true", "pushDownPredicate": "true", "fetchsize": "10000"}
# Rows that one range query should return, and bins of a count.
ROWS_PER_PARTITION = 1_000_000
BINS = 1024
# Condition for part {i} of {n} by a text column's hash, in the dialect of PostgreSQL.
TEXT_HASH = "mod(abs(hashtext({column})::bigint), {n}) = {i}"


def quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def _width(low, high) -> float:
    """How far apart two bounds are; 0 for kinds that Spark cannot split."""
    if isinstance(low, bool) or low is None:
        return 0
    if isinstance(low, (int, decimal.Decimal)):
        return float(high - low)
    if isinstance(low, dt.datetime):
        return (high - low).total_seconds()
    if isinstance(low, dt.date):
        return (high - low).days
    return 0


def _bound(value, last: bool) -> int | str:
    """Bounds as Spark takes them; the last one is past the largest number."""
    if isinstance(value, (int, decimal.Decimal)):
        return int(value) + last
    return value.isoformat(sep=" ") if isinstance(value, dt.datetime) else value.isoformat()


def equal_ranges(count_bins: Callable[[int, int, int], Mapping[int, int]], low: int, high: int, rows: int, parts: int) -> list[int]:
    """First keys of all ranges but the first, each of at most about rows / parts rows.

    ``count_bins(low, high, step)`` gives the rows of each bin of width
    ``step`` from ``low`` up to ``high``, exclusive. A range has more rows only
    where one key has; two neighbours have more than one range's rows together.
    """
    target = max(1, -(-rows // parts))
    bins: list[tuple[int, int]] = []
    todo = [(low, high)]
    while todo:
        first, last = todo.pop()
        step = max(1, -(-(last - first) // BINS))
        for k, n in count_bins(first, last, step).items():
            start = first + k * step
            if n > target and step > 1:
                todo.append((start, min(last, start + step)))
            else:
                bins.append((start, n))
    cuts, held = [], 0
    for start, n in sorted(bins):
        if held and held + n > target:
            cuts.append(start)
            held = 0
        held += n
    return cuts


def _range_predicates(column: str, cuts: Sequence[int]) -> list[str]:
    """Conditions that part all rows at the cuts; NULL keys go with the first part."""
    if not cuts:
        return ["1 = 1"]
    middle = [f"{column} >= {a} and {column} < {b}" for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    return [f"{column} < {cuts[0]} or {column} is null", *middle, f"{column} >= {cuts[-1]}"]


def read_table(
    spark: SparkSession,
    url: str,
    schema: str,
    table: str,
    properties: Mapping[str, str],
    partition_columns: Sequence[str] = (),
    max_partitions: int | None = None,
    rows_per_partition: int = ROWS_PER_PARTITION,
    text_hash: str = TEXT_HASH,
) -> DataFrame:
    """``max_partitions`` bounds the queries, and so the connections at once, where the database needs it."""
    qualified = f"{quoted(schema)}.{quoted(table)}"
    props = {**DEFAULTS, **dict(properties)}
    if not partition_columns or max_partitions == 1:
        return spark.read.jdbc(url, qualified, properties=props)
    asked = ", ".join(f"min({quoted(c)}) as lo{i}, max({quoted(c)}) as hi{i}"
                      for i, c in enumerate(partition_columns))
    found = spark.read.jdbc(
        url, f"(select count(*) as n, {asked} from {qualified}) b", properties=props
    ).first()
    rows = int(found["n"])
    wanted = -(-rows // rows_per_partition)
    parts = min(wanted, max_partitions or wanted)
    widest = max(range(len(partition_columns)),
                 key=lambda i: _width(found[f"lo{i}"], found[f"hi{i}"]))
    low, high = found[f"lo{widest}"], found[f"hi{widest}"]
    column = quoted(partition_columns[widest])
    if parts > 1 and isinstance(low, (int, decimal.Decimal)) and not isinstance(low, bool) and _width(low, high):

        def count_bins(first: int, last: int, step: int) -> dict[int, int]:
            """At most BINS rows: the database counts."""
            bin_ = f"floor(({column} - {first}) / {step}.0)"
            counted = f"(select {bin_} as bin, count(*) as n from {qualified} where {column} >= {first} and {column} < {last} group by {bin_}) b"
            return {int(r["bin"]): int(r["n"]) for r in spark.read.jdbc(url, counted, properties=props).collect()}

        cuts = equal_ranges(count_bins, math.floor(low), math.floor(high) + 1, rows, parts)
        return spark.read.jdbc(url, qualified, predicates=_range_predicates(column, cuts), properties=props)
    texts = [c for i, c in enumerate(partition_columns) if isinstance(found[f"lo{i}"], str)]
    if parts > 1 and not _width(low, high) and texts:
        column = quoted(texts[0])
        hashed = [text_hash.format(column=column, n=parts, i=i) for i in range(parts)]
        hashed[0] = f"{hashed[0]} or {column} is null"
        return spark.read.jdbc(url, qualified, predicates=hashed, properties=props)
    if parts <= 1 or not _width(low, high):
        return spark.read.jdbc(url, qualified, properties=props)
    return spark.read.jdbc(
        url,
        qualified,
        column=column,
        lowerBound=_bound(low, False),
        upperBound=_bound(high, True),
        numPartitions=parts,
        properties=props,
    )


class JdbcSource(Mapping):
    """The catalogue's tables in one database schema, read on first access
    and split on one of their key columns."""

    def __init__(self, spark: SparkSession, url: str, properties: Mapping[str, str],
                 schema: str = "public", max_partitions: int | None = None):
        self.spark, self.url, self.properties = spark, url, properties
        self.schema, self.max_partitions = schema, max_partitions
        self._frames: dict[str, DataFrame] = {}

    def __getitem__(self, table: str) -> DataFrame:
        if table not in self._frames:
            spec = {t.name: t for t in select_tables()}[table]
            self._frames[table] = read_table(
                self.spark, self.url, self.schema, table, self.properties,
                partition_columns=spec.key, max_partitions=self.max_partitions,
            )
        return self._frames[table]

    def __iter__(self):
        return iter(t.name for t in select_tables())

    def __len__(self) -> int:
        return len(select_tables())
