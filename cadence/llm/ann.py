"""Approximate nearest neighbours by shifted space-filling curves.

Vectors are projected to a few dimensions, several times, with random
rotations and shifts; each projection orders all vectors along a Hilbert
curve. Spark range-partitions each order. A query looks at the rows within a
window of its own place on each curve; what the windows hold is scored on the
original vectors, and the best of all curves are merged.

How wide the window must be depends on the data: it is fitted on a bounded
sample of queries (FIT_QUERIES), whose true neighbours are found by brute
force, as the width that reaches FIT_RECALL of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadence.llm.common import materialise, row_id

#: Curves; dimensions of each and bits of a dimension.
CURVES, DIMENSIONS, BITS = 8, 4, 12
#: Rows on which projections are scaled, queries on which the window is fitted, and their recall.
FIT_ROWS, FIT_QUERIES, FIT_RECALL = 20_000, 256, 0.94
#: Least window, in neighbours wanted, and rows of a block of candidates.
LEAST_WINDOW, BLOCK_LOW, BLOCK_HIGH = 10, 1024, 8192


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of grid cells (n x d, below 2^bits).

    Going from the highest bit, each level of the grid is mirrored and turned
    so that the curve enters and leaves it at the right corners; the bits of
    all dimensions, Gray-coded, then interleave to the key.
    """
    x = [c.copy() for c in cells.T.astype(np.uint64)]
    one = np.uint64(1)
    for level in range(bits - 1, 0, -1):
        bit, lower = np.uint64(1 << level), np.uint64((1 << level) - 1)
        for i in range(len(x)):
            up = (x[i] & bit) != 0
            swap = np.where(up, np.uint64(0), (x[0] ^ x[i]) & lower)
            x[0] = np.where(up, x[0] ^ lower, x[0] ^ swap)
            x[i] = x[i] ^ swap if i else x[i]
    for i in range(1, len(x)):
        x[i] = x[i] ^ x[i - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn = np.where((x[-1] >> np.uint64(level)) & one == 1, turn ^ np.uint64((1 << level) - 1), turn)
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for c in x:
            key = (key << one) | (((c ^ turn) >> np.uint64(level)) & one)
    return key


class Projection:
    """Rotations, scales and shifts of all curves, from a sample and a seed."""

    def __init__(self, sample: np.ndarray, curves: int, dimensions: int, bits: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        size = sample.shape[1]
        self.bits, self.axes = bits, []
        for _ in range(curves):
            axes = np.linalg.qr(rng.normal(size=(size, min(dimensions, size))))[0]
            at = sample @ axes
            spread = at.std(0)
            self.axes.append((axes, at.mean(0), np.where(spread > 0, spread, 1.0), rng.uniform(-0.5, 0.5, axes.shape[1])))

    def keys(self, vectors: np.ndarray) -> list[np.ndarray]:
        out = []
        for axes, middle, spread, shift in self.axes:
            at = np.clip((vectors @ axes - middle) / spread + shift, -30, 30)
            share = 1 / (1 + np.exp(-1.7 * at))
            out.append(hilbert_keys(np.minimum(share * (1 << self.bits), (1 << self.bits) - 1), self.bits).astype(np.int64))
        return out


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of equal length as a matrix of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> list[np.ndarray]:
    """Per row the columns of the k largest scores, largest first, ties to the smaller id; -inf takes no part."""
    out = []
    for row in scores:
        some = np.flatnonzero(row >= np.partition(row, len(row) - k)[len(row) - k]) if len(row) > k else np.arange(len(row))
        some = some[row[some] > -np.inf]
        out.append(some[np.lexsort((ids[some], -row[some]))][:k])
    return out


def taking_part(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """``vec_id`` and ``embedding`` of the rows that can be compared.

    Rows with a null number, and vectors that are null, empty, zero, or hold
    null or non-finite components, take no part; nor do vectors of another
    length than most have.
    """
    e = F.col(embedding)
    fine = e.isNotNull() & (F.size(e) > 0) & F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(e, lambda x: x != 0)
    rows = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), e.alias("embedding")).filter(F.col("vec_id").isNotNull() & F.coalesce(fine, F.lit(False)))
    lengths = rows.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return rows.filter(F.size("embedding") == (lengths[0].n if lengths else 0))


def _thinned(rows: DataFrame, limit: int) -> DataFrame:
    """``limit`` rows by the hash of their number; a bound on the hash first, so that few more reach the task that sorts them."""
    n = rows.count()
    hashed = F.xxhash64("vec_id")
    if n > 4 * limit:
        rows = rows.filter(F.shiftrightunsigned(hashed, 1) < int(4 * limit / n * 2.0**63))
    return rows.orderBy(hashed, "vec_id").limit(limit)


def _classes(rows: DataFrame, is_query: Column) -> tuple[DataFrame, DataFrame]:
    """Different vectors, and the members of each.

    Classes have ``vec_id`` (a number of the class, in the order of the smallest
    numbers that they hold), ``embedding``, ``asked`` (holds a query); members
    ``cls``, ``vec_id``, ``is_query``. Vectors are told apart by 128 bits.
    """
    e = F.col("embedding")
    named = rows.select("vec_id", "embedding", F.xxhash64(e).alias("_h"), F.xxhash64(F.lit(1), e).alias("_g"), F.coalesce(is_query, F.lit(False)).alias("is_query"))
    once = named.groupBy("_h", "_g").agg(F.min("vec_id").alias("_low"), F.first("embedding").alias("embedding"), F.max("is_query").alias("asked"))
    classes = materialise(once.orderBy("_low", "_h", "_g").withColumn("cls", row_id()), "ann-classes")
    members = named.drop("embedding").join(classes.select("_h", "_g", "cls"), ["_h", "_g"]).select("cls", "vec_id", "is_query")
    return classes.select(F.col("cls").alias("vec_id"), "embedding", "asked"), materialise(members, "ann-members")


def _expanded(found: DataFrame, classes: DataFrame, members: DataFrame, k: int) -> DataFrame:
    """Numbers for classes: each query's candidates, at most k + 1 (its own among them or not), from its class's nearest classes."""
    own = classes.filter("asked").select(F.col("vec_id").alias("query_id"), "vec_id", F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")).alias("score"))
    near = found.select("query_id", "vec_id", "score").unionByName(own)
    # Spark drops what is beyond the k + 1 smallest numbers of a class before it shuffles them.
    smallest = Window.partitionBy("cls").orderBy("vec_id")
    few = members.select("cls", "vec_id").distinct().withColumn("_n", F.row_number().over(smallest)).filter(F.col("_n") <= k + 1)
    numbers = near.join(few.select("cls", F.col("vec_id").alias("member")), near.vec_id == F.col("cls")).select(F.col("query_id"), F.col("member").alias("vec_id"), "score")
    wanted = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    once = numbers.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")).withColumn("_n", F.row_number().over(wanted)).filter(F.col("_n") <= k + 1)
    # A list of at most k + 1 per class; a class that very many queries share is a hot key of a join, which Spark can split.
    lists = materialise(once.groupBy("query_id").agg(F.collect_list(F.struct("vec_id", "score")).alias("near")), "ann-lists")
    asked = members.filter("is_query").select("cls", F.col("vec_id").alias("query_id"))
    each = asked.join(lists.select(F.col("query_id").alias("cls"), "near"), "cls").select("query_id", F.explode("near").alias("n"))
    return each.select("query_id", "n.vec_id", "n.score").filter(F.col("vec_id") != F.col("query_id"))


def _top(scored: DataFrame, k: int) -> DataFrame:
    """Each query's k best: largest score, ties to the smaller number; a vector counts once."""
    once = scored.repartition("query_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return once.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def brute_force(rows: DataFrame, queries: list[tuple[int, np.ndarray]], k: int) -> DataFrame:
    """The true neighbours of a bounded list of queries, against all rows in batches."""
    ids = np.array([q for q, _ in queries], np.int64)
    points = np.stack([v for _, v in queries])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            own = batch.column("vec_id").to_numpy()
            scores = points @ _matrix(batch.column("embedding")).T
            scores[ids[:, None] == own[None, :]] = -np.inf
            best = _best(scores, own, k)
            n = [len(b) for b in best]
            flat = np.concatenate(best)
            at = np.repeat(np.arange(len(ids)), n)
            yield pa.RecordBatch.from_arrays([pa.array(ids[at]), pa.array(own[flat]), pa.array(scores[at, flat])], names=["query_id", "vec_id", "score"])

    return _top(rows.mapInArrow(run, "query_id bigint, vec_id bigint, score double"), k)


def _on_curves(rows: DataFrame, projection: Projection) -> DataFrame:
    """Every vector at its place on each curve: curve, at (0, 1, ...), vec_id, embedding, asked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                for curve, keys in enumerate(projection.keys(_matrix(batch.column("embedding")))):
                    number = pa.array(np.full(batch.num_rows, curve, np.int32))
                    yield pa.RecordBatch.from_arrays([number, pa.array(keys), batch.column("vec_id"), batch.column("embedding"), batch.column("asked")],
                                                          names=["curve", "key", "vec_id", "embedding", "asked"])

    kind = dict(rows.dtypes)["embedding"]
    keyed = rows.mapInArrow(run, f"curve int, key bigint, vec_id bigint, embedding {kind}, asked boolean")
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["curve", "key", "vec_id"]
    placed = materialise(keyed.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_row", row_id()), "ann-curves")
    part = F.shiftright("_row", 33).alias("_part")
    counts = placed.groupBy("curve", part).agg(F.count("*").alias("_n"), F.min("_row").alias("_low"))
    before = Window.partitionBy("curve").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = materialise(counts.select("curve", "_part", "_low", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first")), "ann-parts")
    return placed.withColumn("_part", part).join(firsts, ["curve", "_part"]).select(
        "curve", (F.col("_first") + F.col("_row") - F.col("_low")).alias("at"), "vec_id", "embedding", "asked")


def _fit_window(placed: DataFrame, rows: DataFrame, queries: DataFrame, k: int, recall: float) -> int:
    """Rows to each side of a query that hold ``recall`` of the sample's true neighbours on some curve."""
    sample = _thinned(queries, FIT_QUERIES).collect()
    if not sample:
        return LEAST_WINDOW * k
    true = brute_force(rows, [(r.vec_id, np.array(r.embedding, np.float64)) for r in sample], k)
    at = placed.select("curve", "at", "vec_id")
    pairs = true.join(at, "vec_id").join(at.select("curve", F.col("vec_id").alias("query_id"), F.col("at").alias("_own")), ["curve", "query_id"])
    near = pairs.groupBy("query_id", "vec_id").agg(F.min(F.abs(F.col("at") - F.col("_own"))).alias("_apart"))
    wide = near.agg(F.percentile("_apart", recall)).first()[0]
    return max(LEAST_WINDOW * k, int(wide or 0) + 1)


def _score_block(k: int, window: int):
    def run(candidates: pa.Table, queries: pa.Table) -> pa.Table:
        found = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        if candidates.num_rows and queries.num_rows:
            ids, at = candidates.column("vec_id").to_numpy(), candidates.column("at").to_numpy()
            own, place = queries.column("q_vec_id").to_numpy(), queries.column("q_at").to_numpy()
            vectors, points = _matrix(candidates.column("embedding")), _matrix(queries.column("q_embedding"))
            parts = []
            for i in range(0, len(own), 512):
                rows = slice(i, i + 512)
                scores = points[rows] @ vectors.T
                scores[(np.abs(place[rows, None] - at[None, :]) > window) | (own[rows, None] == ids[None, :])] = -np.inf
                for query, row, best in zip(own[rows], scores, _best(scores, ids, k), strict=True):
                    parts.append((np.full(len(best), query), ids[best], row[best]))
            found = [np.concatenate(c) for c in zip(*parts, strict=True)]
        return pa.table({"query_id": found[0].astype(np.int64), "vec_id": found[1].astype(np.int64), "score": found[2].astype(np.float64)})

    return run


def search(vectors: DataFrame, is_query: Column, k: int = 20, vec_id: str = "vec_id", embedding: str = "embedding", curves: int = CURVES,
           recall: float = FIT_RECALL) -> DataFrame:
    """``query_id``, ``rank`` from 1, ``vec_id``, ``score``: the k nearest found of each query.

    ``is_query`` is a condition on ``vec_id``; candidates are all rows but
    those of the query's own number. Nearness is the inner product in double
    precision on the original vectors; ties go to the smaller number. A query
    with fewer candidates gets all of them. Rows of the same number count as
    one vector, scored by the nearest. Other columns are not read.
    """
    rows = taking_part(vectors, vec_id, embedding)
    classes, members = _classes(rows, is_query)
    sample = _thinned(classes, FIT_ROWS).select("embedding").toArrow()
    if not sample.num_rows:
        return rows.select(F.col("vec_id").alias("query_id"), F.lit(0).alias("rank"), "vec_id", F.lit(0.0).alias("score")).limit(0)
    placed = _on_curves(classes, Projection(_matrix(sample.column("embedding")), curves, DIMENSIONS, BITS))
    window = _fit_window(placed, classes, classes.filter("asked"), k, recall)
    block = min(BLOCK_HIGH, max(BLOCK_LOW, window))
    held = placed.withColumn("block", F.floor(F.col("at") / block))
    first, last = F.greatest(F.floor((F.col("at") - window) / block), F.lit(0)), F.floor((F.col("at") + window) / block)
    asked = placed.filter("asked").withColumn("block", F.explode(F.sequence(first, last)))
    asked = asked.select(*[F.col(c).alias(f"q_{c}") for c in asked.columns])
    scored = held.groupBy("curve", "block").cogroup(asked.groupBy("q_curve", "q_block")).applyInArrow(
        _score_block(k, window), "query_id bigint, vec_id bigint, score double")
    best = materialise(_top(scored, k), "ann-best")
    return _top(_expanded(best, classes, members, k), k).select("query_id", "rank", "vec_id", "score")
