"""Best-two-fit packing of token sequences.

Documents are encoded once; pieces of at most ``capacity`` tokens go to a
table. What decides a piece's place is only its length, so bins are planned
over the histogram of lengths (at most ``capacity`` numbers, however many
documents): a bin is filled greedily with the longest pieces that fit, then
its smallest piece is replaced with the two unpacked pieces that fit the
expanded gap most tightly, if they fit it better. A bin's pattern is repeated
while its lengths last. The r-th piece of a length then looks up its bin.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadence.llm.common import arrow_schema, materialise, slices, text_buffer
from cadence.llm.tokens import cut_ids, encoder

RESULT = ("piece", "start", "length", "ids", "ids_crc32", "sequence_id", "offset")


def _largest(free: np.ndarray, gap: int) -> int:
    """The largest length with a free piece that fits the gap, or 0."""
    found = np.flatnonzero(free[: gap + 1])
    return int(found[-1]) if len(found) else 0


def _two_fit(free: np.ndarray, gap: int, over: int) -> tuple[int, int] | None:
    """Two free lengths whose sum is largest, over ``over`` and at most ``gap``."""
    have = np.flatnonzero(free[: gap + 1])
    best, pair = over, None
    for first in have[::-1]:
        if 2 * first < best or best == gap:
            break
        rest = min(gap - int(first), int(first))
        if rest > 0:
            second = _largest(free, rest)
            if second == first and free[first] < 2:
                second = _largest(free, int(first) - 1)
            if second and first + second > best:
                best, pair = int(first + second), (int(first), second)
    return pair


def plan_bins(counts: np.ndarray, capacity: int) -> tuple[dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]], int]:
    """Places for all pieces: for each length the first rank, first bin and offset of each run.

    ``counts[l]`` pieces have the length l. A run of ranks of one length goes
    to consecutive bins of one pattern at one offset. Also the number of bins.
    """
    left = counts.astype(np.int64).copy()
    used = np.zeros_like(left)
    runs: dict[int, list[tuple[int, int, int]]] = {}
    bins = 0
    while left.any():
        free, gap, bin_ = left.copy(), capacity, []
        while length := _largest(free, gap):
            bin_.append(length)
            free[length] -= 1
            gap -= length
        if gap and len(bin_) > 1:
            smallest = bin_[-1]
            if pair := _two_fit(free, gap + smallest, smallest):
                bin_[-1:] = pair
        need = np.bincount(bin_, minlength=len(left))
        times = int((left[need > 0] // need[need > 0]).min())
        offset = 0
        for length in bin_:
            runs.setdefault(length, []).append((int(used[length]), bins, offset))
            used[length] += times
            offset += length
        left -= need * times
        bins += times
    return {k: tuple(np.array(x, np.int64) for x in zip(*v, strict=True)) for k, v in runs.items()}, bins


def _pieces(tokenizer: str, text: str, carry: list[str], end_id: int | None, capacity: int):
    """Encode, cut, and number the pieces of each length within the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc, part = encoder(tokenizer), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in slices(batches, text):
            coded, at = enc.encode_buffer(*text_buffer(batch.column(text)))
            if end_id is not None:
                coded, at = np.insert(coded, at[1:], end_id), at + np.arange(len(at))
            docs, piece, start, length, ids = [], [], [], [], []
            for i, text_ids in enumerate(cut_ids(coded, at)):
                n, to = len(text_ids) // 4, 0
                while to < n:
                    k, done = (piece[-1] + 1 if to else 0), to
                    to += capacity if to else n % capacity or capacity
                    docs.append(i)
                    piece.append(k)
                    start.append(done)
                    length.append(to - done)
                    ids.append(text_ids[4 * done : 4 * to])
            size = np.array(length, np.int64)
            order = np.argsort(size, kind="stable")
            ranks = np.arange(len(size)) - np.searchsorted(size[order], size[order], "left")
            rank = np.empty(len(size), np.int64)
            rank[order] = ranks
            rank += seen[size]
            seen += np.bincount(size, minlength=capacity + 1)
            rows = pa.array(docs, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(rows) for c in carry), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(size), pa.array(ids, pa.binary()),
                 pa.array(np.full(len(size), part, np.int32)), pa.array(rank)],
                names=[*carry, "piece", "start", "length", "ids", "_part", "_rank"])

    return run


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int | None = None, capacity: int = 1024, text: str = "text",
                   carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """A row per piece: carried columns, piece, start, length, ids, ids_crc32, sequence_id, offset.

    ``ids`` holds the piece's ids as little-endian unsigned 32-bit integers,
    ``ids_crc32`` their checksum; a reader who wants no ids moves none.
    Only documents over ``capacity`` tokens are cut, the first piece taking
    what is over; null texts are empty, and without an ``end_id`` a document
    without tokens has no piece. Equal lengths are interchangeable, so ties and
    repeated rows need no order. A carried column that has the name of a
    result, or ``_part``, ``_rank``, ``_first`` or ``_at``, gives way. An empty table packs into
    nothing.
    """
    carry = [c for c in carry if c not in (*RESULT, "_part", "_rank", "_first", "_at")]
    rows = docs.select(text, *[c for c in carry if c != text])
    kept = arrow_schema(rows, carry)
    schema = f"{kept}{', ' if kept else ''}piece int, start bigint, length bigint, ids binary, _part int, _rank bigint"
    names = [f.name for f in rows.schema.fields if f.name in carry]
    pieces = materialise(rows.mapInArrow(_pieces(tokenizer, text, names, end_id, capacity), schema), "packing")
    pieces = pieces.withColumn("ids_crc32", F.crc32("ids"))
    counts = pieces.groupBy("_part", "length").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.withColumn("_first", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    histogram = np.zeros(capacity + 1, np.int64)  # at most `capacity` rows
    for length, n in counts.groupBy("length").agg(F.sum("_n")).collect():
        histogram[length] = n
    places, _ = plan_bins(histogram, capacity)

    @F.pandas_udf("sequence_id bigint, offset bigint")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        length, rank = length.to_numpy(), rank.to_numpy()
        out = np.empty((2, len(length)), np.int64)
        for size in np.unique(length):
            at = np.flatnonzero(length == size)
            ranks, bins, offsets = places[int(size)]
            run = np.searchsorted(ranks, rank[at], "right") - 1
            out[0, at] = bins[run] + rank[at] - ranks[run]
            out[1, at] = offsets[run]
        return pd.DataFrame({"sequence_id": out[0], "offset": out[1]})

    placed = pieces.join(firsts, ["_part", "length"]).withColumn("_at", place("length", F.col("_first") + F.col("_rank")))
    return placed.select(*names, "piece", "start", "length", "ids", "ids_crc32", "_at.sequence_id", "_at.offset")


