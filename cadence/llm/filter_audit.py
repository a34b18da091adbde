"""Filter interaction audit: what each filter removes, in every order.

Filters A to D look at one text; E removes copies of the text of a smaller
document id. Copies are found in two steps: a counting Bloom filter over all
texts is summed up from the tasks' partial counts, and texts of which one
counter shows a single text are unique for sure. Only the others, possible
repeats, are shuffled whole for the exact smallest id of each text. Failures
are a bit mask per document; masks are counted per part, and every order of
the filters is worked out from those few counts.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cadence.llm.common import materialise, slices, text_buffer

FILTERS = "ABCDE"
#: Counters of the Bloom filter for each document, and how many each text has.
COUNTERS, HASHES = 16, 2
#: Bytes that the merged filter may have (one bit a counter). A table with more documents than
#: fit gets a filter of this size: it then clears fewer texts, and the result is the same.
SKETCH_BYTES = 128 << 20
#: Counters of one row of the merged filter.
SLICE_BITS = 20


@dataclass(frozen=True)
class Limits:
    """Fixed values of the filters: a text fails A under ``words`` words, B under ``distinct`` percent
    different words, C over ``upper`` percent A-Z, D if it holds one of ``symbols``."""

    words: int = 200
    distinct: int = 50
    upper: int = 2
    symbols: bytes = b"#$%&*|"


def _sums(found: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(found, dtype=np.int64)])
    return total[ends[1:]] - total[ends[:-1]]


def text_failures(data: np.ndarray, ends: np.ndarray, limits: Limits) -> np.ndarray:
    """Bits of A to D for each text."""
    raw, at = data.tobytes(), ends.tolist()
    words = np.zeros((2, len(ends) - 1), np.int64)
    for k, (a, b) in enumerate(zip(at[:-1], at[1:], strict=True)):
        found = raw[a:b].split()
        words[:, k] = len(found), len(set(found))
    upper, points = _sums((data >= 65) & (data <= 90), ends), _sums((data & 0xC0) != 0x80, ends)
    symbol = np.zeros(256, bool)
    symbol[list(limits.symbols)] = True
    fails = (words[0] < limits.words, 100 * words[1] < limits.distinct * words[0], 100 * upper > limits.upper * points, _sums(symbol[data], ends) > 0)
    return sum(f.astype(np.int32) << k for k, f in enumerate(fails))


def _counters(text: Column, slots: int) -> list[Column]:
    """The places of a text's counters."""
    return [F.pmod(F.xxhash64(F.lit(k), text), F.lit(slots)) for k in range(HASHES)]


def busy_counters(docs: DataFrame, text: Column, slots: int) -> np.ndarray:
    """One bit per counter: whether two texts or more came to it.

    Counts are summed in each task before they meet, so a text on a third of
    all rows is a few rows. What is collected has ``slots`` bits.
    """
    counted = docs.select(F.explode(F.array(*_counters(text, slots))).alias("slot")).groupBy("slot").agg(F.count("*").alias("texts"))
    busy = counted.filter("texts > 1").select(F.shiftright("slot", SLICE_BITS).alias("slice"), F.col("slot").bitwiseAND((1 << SLICE_BITS) - 1).cast("int").alias("place"))

    def bitmap(group: pa.Table) -> pa.Table:
        bits = np.zeros(1 << SLICE_BITS, bool)
        bits[group.column("place").to_numpy()] = True
        return pa.table({"slice": group.column("slice")[:1], "bits": pa.array([np.packbits(bits).tobytes()])})

    merged = np.zeros((max(1, slots >> SLICE_BITS), 1 << SLICE_BITS >> 3), np.uint8)
    for row in busy.groupBy("slice").applyInArrow(bitmap, "slice bigint, bits binary").collect():
        merged[row.slice] = np.frombuffer(row.bits, np.uint8)
    return merged.reshape(-1)


def sketch_slots(rows: int, limit: int = SKETCH_BYTES) -> int:
    """Counters for so many documents: a power of 2, at most 8 to a byte of ``limit``."""
    return min(1 << max(10, (COUNTERS * rows - 1).bit_length()), 1 << ((8 * limit).bit_length() - 1))


def failures(docs: DataFrame, part: Column, text: str = "text", key: str = "doc_id", limits: Limits = Limits(), sketch_bytes: int = SKETCH_BYTES) -> DataFrame:
    """``doc_id``, ``part``, ``mask`` of A to D, and for possible repeats ``digest`` and ``text``; a table.

    Unique texts leave their scan as a few bytes; a null text is empty.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    slots = sketch_slots(docs.count(), sketch_bytes)
    seen = docs.sparkSession.sparkContext.broadcast(busy_counters(docs, whole, slots))
    places = _counters(whole, slots)
    kept = docs.select(F.col(key).cast("bigint").alias("doc_id"), part.cast("string").alias("part"), whole.alias("text"), *[p.alias(f"slot{k}") for k, p in enumerate(places)])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = seen.value
        for batch in slices(batches, "text"):
            data, ends = text_buffer(batch.column("text"))
            repeat = np.ones(batch.num_rows, bool)
            for k in range(HASHES):
                place = batch.column(f"slot{k}").to_numpy()
                repeat &= (bits[place >> 3] >> (7 - (place & 7)).astype(np.uint8) & 1).astype(bool)
            raw = data.tobytes()
            digest = [hashlib.sha256(raw[a:b]).digest() if r else None for a, b, r in zip(ends[:-1].tolist(), ends[1:].tolist(), repeat.tolist(), strict=True)]
            text_left = batch.column("text").take(pa.array(np.arange(batch.num_rows), mask=~repeat))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("part"), pa.array(text_failures(data, ends, limits), pa.int32()),
                                              pa.array(digest, pa.binary()), text_left], names=["doc_id", "part", "mask", "digest", "text"])

    return materialise(kept.mapInArrow(judge, "doc_id bigint, part string, mask int, digest binary, text string"), "filter-masks")


def _with_copies(rows: DataFrame, firsts: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Counts ``n`` per ``part``, ``mask`` with the bit of E, and ``extra``.

    Of the rows of one text in one (part, mask, extra) those with the text's
    smallest id pass E; so do rows without an id. Rows are counted per group
    before they meet the text's smallest id: a hot text is a few rows there.
    """
    by = ["part", "mask", *extra]
    alone = rows.filter("digest IS NULL").groupBy(*by).agg(F.count("*").alias("n"))
    ids = rows.filter("digest IS NOT NULL").groupBy(*by, "digest", "doc_id").agg(F.count("*").alias("n"))
    known = F.col("doc_id").isNotNull()
    groups = ids.groupBy(*by, "digest").agg(F.sum("n").alias("all"), F.sum(F.when(known, F.col("n")).otherwise(0)).alias("with_id"),
                                            F.min(F.when(known, F.struct("doc_id", "n"))).alias("low"))
    late = F.col("with_id") - F.when(F.col("low.doc_id") == F.col("first"), F.col("low.n")).otherwise(0)
    split = groups.join(firsts, "digest").select(*by, "all", late.alias("late"))
    e = 1 << FILTERS.index("E")
    both = F.explode(F.array(F.struct(F.col("mask").alias("m"), (F.col("all") - F.col("late")).alias("n")),
                             F.struct(F.col("mask").bitwiseOR(F.lit(e)).alias("m"), F.col("late").alias("n"))))
    split = split.select("part", *extra, both.alias("x")).select("part", F.col("x.m").alias("mask"), *extra, F.col("x.n").alias("n"))
    return alone.unionByName(split).filter("n > 0").groupBy(*by).agg(F.sum("n").alias("n"))


def mask_counts(docs: DataFrame, labels: DataFrame, part: Column, text: str = "text", key: str = "doc_id",
                limits: Limits = Limits(), sketch_bytes: int = SKETCH_BYTES) -> DataFrame:
    """``part``, ``mask`` (bit k: fails filter k), and documents: ``n``, labelled ``good`` and ``toxic``; a table."""
    rows = failures(docs, part, text, key, limits, sketch_bytes)
    firsts = rows.filter("digest IS NOT NULL").groupBy("digest", "text").agg(F.min("doc_id").alias("first")).select("digest", "first")
    # As a table: the texts are compared once for both counts.
    firsts = materialise(firsts, "first-copies")
    label = labels.groupBy("doc_id").agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
                                         F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    slim = rows.drop("text")
    labelled = _with_copies(slim.join(label.filter("good OR toxic"), "doc_id"), firsts, ("good", "toxic"))
    n, zero = F.col("n"), F.lit(0).cast("bigint")
    every = _with_copies(slim, firsts).select("part", "mask", "n", zero.alias("good"), zero.alias("toxic"))
    some = labelled.select("part", "mask", zero.alias("n"), F.when(F.col("good"), n).otherwise(0).alias("good"), F.when(F.col("toxic"), n).otherwise(0).alias("toxic"))
    counts = every.unionByName(some).groupBy("part", "mask").agg(F.sum("n").alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic"))
    return materialise(counts, "mask-counts")


def orders(names: str = FILTERS) -> list[tuple[str, int, int, int]]:
    """Each order of the filters, step, its filter's bit, and the bits of the filters before it."""
    return [("".join(p), k + 1, 1 << names.index(p[k]), sum(1 << names.index(x) for x in p[:k]))
            for p in permutations(names) for k in range(len(names))]


def audit(docs: DataFrame, labels: DataFrame, part: Column, text: str = "text", key: str = "doc_id",
          limits: Limits = Limits(), sketch_bytes: int = SKETCH_BYTES) -> DataFrame:
    """One row per ``part``, ``filter_order`` and ``step`` with counts of documents.

    ``kept`` after the step, ``removed`` by it, ``redundant`` (fail its filter,
    were removed before), ``unique_fails`` (fail its filter only),
    ``good_lost`` and ``toxic_lost`` (removed here and so labelled) and
    ``shapley`` (removed by its filter, summed over all orders). A null part
    is the empty string; null texts are empty texts, all equal. Rows count one
    by one, repeated rows too; of equal texts those with the smallest id pass
    E, and a row without an id never fails it. Several labels of one id count
    together; labels without a document, and null labels, count for nothing.
    An empty table has no parts and no rows; other columns are not read.
    """
    counts = mask_counts(docs, labels, F.coalesce(part, F.lit("")), text, key, limits, sketch_bytes)
    listed = json.dumps([dict(zip(("filter_order", "step", "bit", "earlier"), o, strict=True)) for o in orders()])
    steps = F.explode(F.from_json(F.lit(listed), "array<struct<filter_order: string, step: int, bit: int, earlier: int>>"))
    every = counts.select("*", steps.alias("s")).select("part", "mask", "n", "good", "toxic", "s.*")
    fails, gone = F.col("mask").bitwiseAND(F.col("bit")) != 0, F.col("mask").bitwiseAND(F.col("earlier")) != 0

    def total(condition: Column, of: str = "n") -> Column:
        return F.sum(F.when(condition, F.col(of)).otherwise(0)).cast("bigint")

    counted = every.groupBy("part", "filter_order", "step", "bit").agg(
        total(~fails & ~gone).alias("kept"), total(fails & ~gone).alias("removed"), total(fails & gone).alias("redundant"),
        total(F.col("mask") == F.col("bit")).alias("unique_fails"), total(fails & ~gone, "good").alias("good_lost"),
        total(fails & ~gone, "toxic").alias("toxic_lost"))
    shapley = F.sum("removed").over(Window.partitionBy("part", "bit")).alias("shapley")
    return counted.select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", shapley)
