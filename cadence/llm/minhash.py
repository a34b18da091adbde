"""Near-duplicate documents by ProbMinHash, banding and verification.

Each shingle of a text sends arrivals of a Poisson process, at a rate that is
its weight, to random registers; a register keeps the shingle that arrives
first. A text's shingles stop when their next arrival is later than the last
register's, so that few are drawn. Two texts agree in a register with
probability equal to their probability Jaccard similarity. A text is sketched
twice: with weights that grow with the number of times a shingle stands in it,
and with weight 1 for each different shingle, where the similarity is that of
the sets of shingles. Where no shingle is repeated both are the same sketch.
Texts that agree in all registers of a band of either sketch are candidates,
and one measure decides: the exact Jaccard similarity of their sets of
five-word shingles. Classes are connected components.

Equal texts are one node. In a bucket, nodes are tested against the bucket's
smallest node, and where that leaves several classes, against the node with
most links so far: the original, in a group of edited copies. Buckets that
still hold several classes are dealt into blocks, each bucket in its own way,
and all nodes of a block are compared with one another where they lie, with
their shingle sets. Nodes that are then still outside their bucket's largest
class meet all its nodes, in blocks again. A block compares whole sets, by
products of incidence matrices, and returns not pairs but which classes are
connected: a row for each class at most. So no candidate pair is left out
unless its nodes are already in one class, and no pair is a row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import free_name, materialise, slices, text_buffer
from cadence.llm.shingles import shingles
from cadence.llm.tokens import _mix

#: Bands, and registers in each: of pairs with similarity 0.8, 1 in 14,000 shares no band.
BANDS, ROWS = 24, 5
REGISTERS = BANDS * ROWS
THRESHOLD = 0.8
#: Nodes of a block, bytes of their sets, and shingles that are compared together.
BLOCK_NODES, BLOCK_BYTES, COLUMNS = 1024, 32 << 20, 2048


def sketch(text: np.ndarray, shingle: np.ndarray, weight: np.ndarray, texts: int, registers: int) -> np.ndarray:
    """The first shingle to arrive at each register of each text: texts x registers."""
    first = np.full(texts * registers, np.inf)
    out = np.zeros(texts * registers, np.uint64)
    at, active, arrival = np.zeros(len(shingle)), np.arange(len(shingle)), 0
    while len(active):
        arrival += 1
        draw = _mix(shingle[active] + np.uint64(0xA24BAED4963EE407 * arrival % (1 << 64)))
        at[active] -= np.log(((draw >> np.uint64(11)).astype(np.float64) + 1) * 2.0**-53) / weight[active]
        place = text[active] * registers + (_mix(draw + np.uint64(1)) % np.uint64(registers)).astype(np.int64)
        np.minimum.at(first, place, at[active])
        won = first[place] == at[active]
        out[place[won]] = shingle[active[won]]
        own = text[active]
        some = own[np.concatenate([[True], own[1:] != own[:-1]])]
        last = np.zeros(texts)
        last[some] = first.reshape(texts, registers)[some].max(1)
        active = active[at[active] < last[own]]
    return out.reshape(texts, registers)


def band_keys(signature: np.ndarray) -> np.ndarray:
    """A 64-bit key of each band of each signature."""
    keys = np.zeros((len(signature), BANDS), np.uint64)
    for r in range(ROWS):
        keys = _mix(keys * np.uint64(0x9FB21C651E98DF25) + signature[:, r : BANDS * ROWS : ROWS])
    return _mix(keys + np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def weights(count: np.ndarray) -> np.ndarray:
    """Weight of a shingle that stands so many times in its text."""
    return 1 + np.log(count)


def text_bands(owner: np.ndarray, shingle: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The texts that have shingles, and the band keys of each: of its sets' sketch, and of the weighted one if that differs."""
    have = np.unique(owner)
    number = np.searchsorted(have, owner)
    keys = band_keys(sketch(number, shingle, np.ones(len(shingle)), len(have), REGISTERS))
    found = list(keys)
    repeats = np.unique(number[count > 1])
    if len(repeats):
        own = np.isin(number, repeats)
        again = sketch(np.searchsorted(repeats, number[own]), shingle[own], weights(count[own]), len(repeats), REGISTERS)
        for k, more in zip(repeats.tolist(), band_keys(again), strict=True):
            found[k] = np.unique(np.concatenate([keys[k], more]))
    return have, found


def _band_rows(text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            have, keys = text_bands(*shingles(*text_buffer(batch.column(text))))
            ends = np.concatenate([[0], np.cumsum([len(k) for k in keys], dtype=np.int64)]).astype(np.int32)
            flat = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("_node").take(pa.array(have)), lists], names=["_node", "_bands"])

    return run


def _shingle_sets(text: str):
    """Each text's shingles as sorted 32-bit hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            owner, shingle, _ = shingles(*text_buffer(batch.column(text)))
            small = (shingle >> np.uint64(12)).astype("<u4")
            upto = np.searchsorted(owner, np.arange(batch.num_rows + 1))
            sets = [np.unique(small[a:b]).tobytes() for a, b in zip(upto[:-1], upto[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("_node"), pa.array(sets, pa.binary())], names=["_node", "_set"])

    return run


def _verified(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for i, (a, b) in enumerate(zip(batch.column("_sa"), batch.column("_sb"), strict=True)):
                a, b = np.frombuffer(a.as_buffer(), "<u4"), np.frombuffer(b.as_buffer(), "<u4")
                both = len(np.intersect1d(a, b, assume_unique=True))
                if both >= threshold * (len(a) + len(b) - both) - 1e-9:
                    good.append(i)
            yield batch.select(["_a", "_b"]).take(pa.array(good, pa.int64()))

    return run


def _verify(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs that are similar enough, as a table."""
    left = sets.select(F.col("_node").alias("_a"), F.col("_set").alias("_sa"))
    right = sets.select(F.col("_node").alias("_b"), F.col("_set").alias("_sb"))
    both = pairs.join(left, "_a").join(right, "_b").select("_a", "_b", "_sa", "_sb")
    return materialise(both.mapInArrow(_verified(threshold), "_a bigint, _b bigint"), "near-links")


def components(edges: DataFrame) -> DataFrame:
    """``_node`` and ``_class``, the smallest node connected to it, for all nodes with an edge.

    Each round takes the smallest class among neighbours and then that of the
    class itself, so paths shorten by more than half; a round is a table.
    """
    ways = edges.union(edges.select("_b", "_a")).toDF("_node", "_other")
    classes = materialise(ways.groupBy("_node").agg(F.least(F.min("_other"), F.col("_node")).alias("_class")), "near-classes")
    while True:
        seen = ways.join(classes.toDF("_other", "_near"), "_other").groupBy("_node").agg(F.min("_near").alias("_near"))
        step = classes.join(seen, "_node").select("_node", F.least("_class", "_near").alias("_new"), F.col("_class").alias("_old"))
        jump = step.select(F.col("_node").alias("_new"), F.col("_new").alias("_top"))
        new = materialise(step.join(jump, "_new").select("_node", F.least("_new", "_top").alias("_class"), "_old"), "near-classes")
        classes = new.drop("_old")
        if new.filter("_class <> _old").isEmpty():
            return classes


def common(left: list[np.ndarray], right: list[np.ndarray] | None = None) -> np.ndarray:
    """Number of common elements of each set of ``left`` with each of ``right`` (default: with each other one of ``left``)."""
    both = left if right is None else left + right
    size = np.fromiter(map(len, both), np.int64, len(both))
    owner = np.repeat(np.arange(len(both)), size)
    _, column, holders = np.unique(np.concatenate(both), return_inverse=True, return_counts=True)
    shared = holders[column] > 1
    number = np.cumsum(holders > 1) - 1
    owner, column = owner[shared], number[column[shared]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    counts = np.zeros((len(left), len(both) - len(left) if right is not None else len(left)), np.float32)
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        part = slice(*np.searchsorted(column, [first, first + COLUMNS]))
        held = np.zeros((len(both), COLUMNS), np.float32)
        held[owner[part], column[part] - first] = 1
        counts += held[: len(left)] @ (held if right is None else held[len(left) :]).T
    return counts.astype(np.int64)


def _joined(classes: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Classes, and the smallest class that the links between classes ``a`` and ``b`` connect each with, where that is another."""
    names, place = np.unique(np.concatenate([classes, a, b]), return_inverse=True)
    a, b = place[len(classes) : len(classes) + len(a)], place[len(classes) + len(a) :]
    top = np.arange(len(names))
    while True:
        new = top.copy()
        np.minimum.at(new, a, top[b])
        np.minimum.at(new, b, top[a])
        new = new[new]
        if (new == top).all():
            moved = top != np.arange(len(names))
            return names[moved], names[top[moved]]
        top = new


def _links_of(rows: list[tuple], threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Classes that the similar pairs of a block connect: of all its nodes, or of those from outside the
    bucket's largest class with its members."""
    member, outside = [r for r in rows if not r[1]], [r for r in rows if r[1]]
    none = np.zeros(0, np.int64)
    if not member:
        return none, none
    sets = [np.frombuffer(r[4], "<u4") for r in member]
    group, size = np.array([r[3] for r in member], np.int64), np.fromiter(map(len, sets), np.int64, len(sets))
    if not outside:
        if (group == group[0]).all():
            return none, none
        both = common(sets)
        similar = both >= threshold * (size[:, None] + size[None, :] - both) - 1e-9
        a, b = np.nonzero(np.triu(similar & (group[:, None] != group[None, :]), 1))
        return _joined(group, group[a], group[b])
    others = [np.frombuffer(r[4], "<u4") for r in outside]
    theirs, length = np.array([r[3] for r in outside], np.int64), np.fromiter(map(len, others), np.int64, len(others))
    both = common(others, sets)
    similar = both >= threshold * (length[:, None] + size[None, :] - both) - 1e-9
    a, b = np.nonzero(similar & (theirs[:, None] != group[None, :]))
    return _joined(np.concatenate([theirs, group]), theirs[a], group[b])


def _block_rows(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def result(rows: list[tuple]) -> pa.RecordBatch:
            a, b = _links_of(rows, threshold)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["_a", "_b"])

        key, rows = None, []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("_block", "_outside", "_node", "_class", "_set")]
            for row in zip(*columns, strict=True):
                if row[0] != key:
                    if rows:
                        yield result(rows)
                    key, rows = row[0], []
                rows.append(row)
        if rows:
            yield result(rows)

    return run


def _open(members: DataFrame, classes: DataFrame, sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members with their classes, and the buckets of several classes: the largest class, and how many
    blocks the members, and those outside that class, make."""
    own = members.join(classes, "_node", "left").withColumn("_class", F.coalesce("_class", "_node")).join(sets.select("_node", "_size"), "_node")
    within = own.groupBy("_bucket", "_class").agg(F.count("*").alias("_n"), F.sum("_size").alias("_bytes"))
    mixed = within.groupBy("_bucket").agg(F.max(F.struct("_n", "_class", "_bytes")).alias("_largest"), F.sum("_n").alias("_n"), F.sum("_bytes").alias("_bytes"))
    mixed = mixed.filter("_largest._n < _n")
    blocks = lambda n, size: F.greatest(F.ceil(n / BLOCK_NODES), F.ceil(size / BLOCK_BYTES))
    return own.drop("_size"), materialise(mixed.select("_bucket", F.col("_largest._class").alias("_most"), blocks(F.col("_n"), F.col("_bytes")).alias("_ms"),
                                          blocks(F.col("_n") - F.col("_largest._n"), F.col("_bytes") - F.col("_largest._bytes")).alias("_os")), "near-open")


def _compared(dealt: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Links between classes, found in blocks; ``dealt`` has ``_block``, ``_outside``, ``_node``, ``_class``."""
    rows = dealt.join(sets.select("_node", "_set"), "_node").repartition("_block").sortWithinPartitions("_block")
    return materialise(rows.mapInArrow(_block_rows(threshold), "_a bigint, _b bigint"), "near-links")


def _within_blocks(own: DataFrame, mixed: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Links between classes of one block of a bucket; every node is in one block of each of its buckets."""
    part = F.pmod(F.xxhash64("_bucket", "_node"), F.col("_ms"))
    dealt = own.join(mixed, "_bucket").select(F.xxhash64("_bucket", part).alias("_block"), F.lit(False).alias("_outside"), "_node", "_class")
    return _compared(dealt, sets, threshold)


def _across_blocks(own: DataFrame, mixed: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Links of all nodes outside the largest class of a bucket with all its nodes: every block of one meets every block of the other."""
    at = lambda n: F.pmod(F.xxhash64("_node"), F.col(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    held = own.join(mixed, "_bucket")
    rows = [
        held.withColumn("_m", at("_ms")).withColumn("_o", every("_os")).withColumn("_outside", F.lit(False)),
        held.filter("_class <> _most").withColumn("_o", at("_os")).withColumn("_m", every("_ms")).withColumn("_outside", F.lit(True)),
    ]
    fields = [F.xxhash64("_bucket", "_m", "_o").alias("_block"), "_outside", "_node", "_class"]
    return _compared(rows[0].select(*fields).union(rows[1].select(*fields)), sets, threshold)


def classes_of(texts: DataFrame, sets_of, threshold: float = THRESHOLD) -> DataFrame:
    """Classes of the nodes that have a link: ``_node``, ``_class``.

    ``texts`` has ``_node`` and ``_bands``; ``sets_of(nodes)`` gives the shingle sets of some nodes.
    """
    buckets = texts.select("_node", F.explode("_bands").alias("_bucket"))
    shared = buckets.groupBy("_bucket").agg(F.min("_node").alias("_least"), F.max("_node").alias("_most")).filter("_least < _most")
    members = materialise(buckets.join(shared.select("_bucket", "_least"), "_bucket"), "near-buckets")
    sets = materialise(sets_of(members.select("_node").distinct()).withColumn("_size", F.octet_length("_set")), "near-sets")
    tested = materialise(members.filter("_node <> _least").select(F.col("_node").alias("_a"), F.col("_least").alias("_b")).distinct(), "near-pairs")
    links = _verify(tested, sets, threshold)
    members = members.select("_bucket", "_node")
    classes = components(links)
    links = links.union(_verify(_fresh(_to_hubs(members, classes, links), tested), sets, threshold))
    for compare in (_within_blocks, _across_blocks):
        classes = components(links)
        own, mixed = _open(members, classes, sets)
        if mixed.isEmpty():
            return classes
        links = links.union(compare(own, mixed, sets, threshold))
    return components(links)


def _to_hubs(members: DataFrame, classes: DataFrame, links: DataFrame) -> DataFrame:
    """In buckets of several classes: the node with most links, and all nodes of other classes."""
    degree = links.select("_a").union(links.select("_b")).toDF("_node").groupBy("_node").agg(F.count("*").alias("_links"))
    known = materialise(classes.join(degree, "_node", "left"), "near-degrees")
    own = members.join(known, "_node", "left").withColumns({"_class": F.coalesce("_class", "_node"), "_links": F.coalesce("_links", F.lit(0))})
    hubs = own.groupBy("_bucket").agg(F.max(F.struct("_links", "_node", "_class")).alias("_hub"), F.min("_class").alias("_lo"), F.max("_class").alias("_hi"))
    hubs = materialise(hubs.filter("_lo < _hi").select("_bucket", F.col("_hub._node").alias("_other"), F.col("_hub._class").alias("_theirs")), "near-hubs")
    return own.join(hubs, "_bucket").filter("_class <> _theirs").select("_node", "_other")


def _fresh(pairs: DataFrame, tested: DataFrame) -> DataFrame:
    """Different pairs, larger node first, that were not tested."""
    pairs = pairs.select(F.greatest("_node", "_other").alias("_a"), F.least("_node", "_other").alias("_b")).distinct()
    return materialise(pairs.join(tested, ["_a", "_b"], "left_anti"), "near-pairs")


def _digest(text: Column) -> tuple[Column, Column]:
    """Two independent 64-bit hashes of a text."""
    return F.xxhash64(text), F.xxhash64(F.lit(1), text)


def _classified(docs: DataFrame, text: str, doc_id: str, threshold: float) -> DataFrame:
    """``_id``, ``_node``, ``_check`` and ``_class`` of every row with a text.

    Texts of equal hash but different check hash are told apart: only those of
    the smallest check hash stand for the node, others are left alone.
    """
    node, check = _digest(F.col(text))
    keyed = docs.filter(F.col(text).isNotNull()).select(F.col(doc_id).alias("_id"), node.alias("_node"), check.alias("_check"), F.col(text).alias("_text"))
    bands = materialise(keyed.select("_node", "_text").mapInArrow(_band_rows("_text"), "_node bigint, _bands array<bigint>"), "near-sketches")
    once = bands.groupBy("_node").agg(F.first("_bands").alias("_bands"))
    rows = materialise(keyed.drop("_text"), "near-rows")

    def sets_of(nodes: DataFrame) -> DataFrame:
        # One row stands for each node, whatever the number of its copies.
        owner = rows.groupBy("_node").agg(F.min(F.struct("_check", "_id")).alias("_o")).join(nodes, "_node").select("_node", "_o._check", "_o._id")
        texts = keyed.alias("t").join(owner.alias("o"), (F.col("t._node") == F.col("o._node")) & (F.col("t._check") == F.col("o._check")) & F.col("t._id").eqNullSafe(F.col("o._id")))
        made = texts.select(F.col("t._node").alias("_node"), "_text").mapInArrow(_shingle_sets("_text"), "_node bigint, _set binary")
        return made.groupBy("_node").agg(F.first("_set").alias("_set"))

    classes = classes_of(once, sets_of, threshold)
    nodes = rows.groupBy("_node").agg(F.min("_check").alias("_true")).join(classes, "_node", "left")
    # As a table: Spark can then split the rows of a text that very many rows hold.
    joined = rows.join(materialise(nodes, "near-nodes"), "_node")
    return joined.select("_id", "_node", "_check", F.when(F.col("_check") == F.col("_true"), F.coalesce("_class", "_node")).otherwise(F.col("_check")).alias("_class"))


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """A row per document: ``doc_id``, ``class_id``, ``class_size``.

    ``class_id`` is the smallest ``doc_id`` of the class, that of a document
    without near copies its own. Equal texts are in one class, texts without
    words too; null texts stand alone. Repeated rows each give a row and are in
    one class. Texts of under five words have one shingle of all their words.
    Other columns of ``docs`` are not read.
    """
    rows = _classified(docs, text, doc_id, threshold)
    rows = materialise(rows, "near-rows")
    size = materialise(rows.groupBy("_class").agg(F.min("_id").alias("class_id"), F.count("*").alias("class_size")), "near-sizes")
    alone = docs.filter(F.col(text).isNull()).select(F.col(doc_id), F.col(doc_id).alias("class_id"), F.lit(1).cast("bigint").alias("class_size"))
    return rows.join(size, "_class").select(F.col("_id").alias(doc_id), "class_id", "class_size").union(alone)


def keep_one(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one document of each class: that of the smallest ``doc_id``, then hash.

    Of repeated rows (same number and text) one stays; null texts all stay.
    """
    rows = _classified(docs, text, doc_id, threshold)
    best = rows.groupBy("_class").agg(F.min(F.struct(F.col("_id").isNull().alias("_n"), "_id", "_node", "_check")).alias("_b")).select("_b.*")
    a, b, at = (free_name(docs, c) for c in ("_near_node", "_near_check", "_near_best"))
    node, check = _digest(F.col(text))
    keyed = docs.filter(F.col(text).isNotNull()).withColumns({a: node, b: check})
    best = best.select(F.struct("_id", "_node", "_check").alias(at))
    same = (F.col(a) == F.col(f"{at}._node")) & (F.col(b) == F.col(f"{at}._check")) & F.col(doc_id).eqNullSafe(F.col(f"{at}._id"))
    kept = keyed.join(best, same, "left_semi")
    return kept.dropDuplicates([doc_id, a, b]).select(*docs.columns).union(docs.filter(F.col(text).isNull()))
