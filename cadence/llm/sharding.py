"""Sharding: minimax contiguous partition of atomic groups.

Groups (equal texts) are ordered by a 64-bit hash of their text. The smallest
capacity for which a greedy left-to-right filling needs at most ``n_shards``
shards is found by binary search, and the order is cut where that filling
cuts. Only a summary reaches the driver: byte sums per hash prefix, at most
2^16 of them, and below the prefixes in which a cut may fall finer sums, until
the capacity is exact. Rows meet in no shuffle but that of their row numbers.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadence.llm.common import free_name, materialise, row_id

#: Bits of the hash in the first summary, and in each refinement of a prefix.
FIRST_BITS, MORE_BITS = 16, 8
#: Buckets among which the rows of a shard are numbered.
SLOT_BUCKETS = 256


@dataclass
class Summary:
    """Consecutive ranges of groups: bytes, lowest key, whether it is one group."""

    low: np.ndarray
    bytes: np.ndarray
    single: np.ndarray
    prefix: np.ndarray
    bits: np.ndarray

    @property
    def ends(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(self.bytes)])


def _summarise(sized: DataFrame, key: str, size: str, bits: int, within: tuple[int, list[int]] | None) -> Summary:
    if within:
        sized = sized.filter(F.shiftright(key, 64 - within[0]).isin(within[1]))
    found = (
        sized.groupBy(F.shiftright(key, 64 - bits).alias("prefix"))
        .agg(F.min(key).alias("low"), F.max(key).alias("high"), F.sum(size).alias("bytes"))
        .collect()
    )
    found.sort(key=lambda r: r.low)
    column = lambda f, kind=np.int64: np.array([f(r) for r in found], kind)
    return Summary(column(lambda r: r.low), column(lambda r: r.bytes), column(lambda r: r.low == r.high, bool),
                   column(lambda r: r.prefix), np.full(len(found), bits))


def _cuts(ends: np.ndarray, capacity: int, shards: int) -> list[int]:
    """Greedy filling at the known ends: index of the end of each shard."""
    at, cuts = 0, []
    for _ in range(shards):
        at = int(np.searchsorted(ends, ends[at] + capacity, "right")) - 1
        cuts.append(at)
    return cuts


def _reach(s: Summary, ends: np.ndarray, capacity: int, shards: int) -> list[int]:
    """How far each shard could end at best, were unknown ends inside ranges wherever they help."""
    at, found = 0, []
    for _ in range(shards):
        target = at + capacity
        i = int(np.searchsorted(ends, target, "right")) - 1
        at = int(ends[-1]) if i >= len(s.single) else max(at, int(ends[i])) if s.single[i] else target
        found.append(at)
    return found


def _smallest(feasible, low: int, high: int) -> int:
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if feasible(middle) else (middle + 1, high)
    return low


def minimax_cuts(sized: DataFrame, key: str, size: str, shards: int) -> tuple[int, list[int]]:
    """The smallest capacity, and the lowest key of each shard but the first.

    Each round narrows the capacity to [best, sure]: ``best`` if ranges could
    be cut anywhere, ``sure`` with the ends that are known. The ranges that a
    cut could fall into are then summed by longer prefixes.
    """
    s = _summarise(sized, key, size, FIRST_BITS, None)
    if not len(s.bytes):
        return 0, []
    while True:
        ends = s.ends
        total, count = int(ends[-1]), len(s.bytes)
        sure = _smallest(lambda c: _cuts(ends, c, shards)[-1] == count, -(-total // shards), total)
        best = _smallest(lambda c: _reach(s, ends, c, shards)[-1] >= total, -(-total // shards), sure)
        cuts = _cuts(ends, sure, shards)
        if best == sure:
            break
        open_ = np.zeros(count, bool)
        for early, late in zip(_cuts(ends, best, shards), _reach(s, ends, sure, shards), strict=True):
            open_[early : int(np.searchsorted(ends, late, "left")) + 1] = True
        open_ &= ~s.single
        if not open_.any():
            break
        bits = int(s.bits[open_].min())
        now = open_ & (s.bits == bits)
        finer = _summarise(sized, key, size, min(64, bits + MORE_BITS), (bits, [int(p) for p in s.prefix[now]]))
        order = np.argsort(np.concatenate([s.low[~now], finer.low]), kind="stable")
        s = Summary(*(np.concatenate([getattr(s, f)[~now], getattr(finer, f)])[order] for f in ("low", "bytes", "single", "prefix", "bits")))
    return sure, [int(s.low[i]) for i in dict.fromkeys(cuts) if i < count]


def numbered(df: DataFrame, group: str, row: str, to: str) -> DataFrame:
    """Gapless numbers from 0 within each group, however large the group.

    Rows are numbered within ``SLOT_BUCKETS`` hashed parts of a group, whose
    counts (groups times buckets of them) give each part its first number.
    """
    bucket, first = free_name(df, "_bucket"), free_name(df, "_first")
    df = df.withColumn(bucket, F.pmod(F.xxhash64(row), F.lit(SLOT_BUCKETS)))
    before = Window.partitionBy(group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    firsts = df.groupBy(group, bucket).agg(F.count("*").alias(first)).withColumn(first, F.coalesce(F.sum(first).over(before), F.lit(0)))
    within = Window.partitionBy(group, bucket).orderBy(row)
    return df.withColumn(to, F.row_number().over(within) - 1).join(firsts, [group, bucket]).withColumn(to, F.col(to) + F.col(first)).drop(bucket, first)


def text_size(text: Column) -> Column:
    """UTF-8 bytes of a text (null: none) plus 8 for its header."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + 8


def shard_documents(docs: DataFrame, n_shards: int = 24, text: str = "text", carry: tuple[str, ...] = ("doc_id",),
                    measures: dict[str, Column] | None = None) -> DataFrame:
    """Carried columns, ``size``, further ``measures`` of the text, ``shard`` and ``slot``.

    Equal texts share a shard; so do all null texts. The largest shard is as
    small as any cut of the order allows. Ties and repeated rows each get a
    slot of their own; ``slot`` counts a shard's rows from 0 without gaps. A
    shard may stay empty where there are fewer groups than shards; an empty
    table gives no rows. A carried column that has the name of a result gives
    way to the result.
    """
    carry = [c for c in carry if c not in {"size", "shard", "slot", *(measures or {})}]
    kept = docs.select(text, *[c for c in carry if c != text])
    key, row = free_name(kept, "_key"), free_name(kept, "_row")
    made = {key: F.xxhash64(F.col(text).isNull(), F.col(text)), row: row_id(), "size": text_size(F.col(text)), **(measures or {})}
    slim = materialise(kept.select(*carry, *[v.alias(k) for k, v in made.items()]), "sharding")
    _, lows = minimax_cuts(slim, key, "size", n_shards)
    starts = F.array(*[F.lit(x).cast("bigint") for x in lows]) if lows else F.array().cast("array<bigint>")
    shard = F.size(F.filter(starts, lambda x: x <= F.col(key))).cast("int")
    return numbered(slim.withColumn("shard", shard), "shard", row, "slot").drop(key, row)
