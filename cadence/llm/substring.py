"""Substring dedup by content-defined chunks, extended to whole passages.

A gear hash that rolls over words cuts texts where their content says so, so
that an insertion moves only the chunks beside it. Chunks are told apart by
digest, and counted first. They are short and dense enough that words which
make a passage hold one that is cut the same way in every document. Only
around a chunk that two documents hold are passages compared, by a 96-bit
hash of all their words. A sample of them, chosen by that hash, comes first
and settles the inner words of long repeats; passages with a word that it
leaves open, at the edges above all, are then looked up in all documents. So
each word of a document that is in a passage of an earlier one is found, up to
both edges.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm.chunks import SPREAD, word_chunks
from cadence.llm.common import arrow_schema, free_name, materialise, slices, text_buffer
from cadence.llm.shingles import _STEP, hash_words, words_of
from cadence.llm.tokens import _mix

#: Words in a row that make a passage.
LEAST_WORDS = 20
#: Slots of the bit arrays, as a power of 2: 4 MB each. One in so many passages is of the sample.
FILTER_BITS, SAMPLE = 25, 6
#: Step of the check, a further 32 bits of the hash: any odd number but that of the first.
_CHECK = np.uint64(0x9E3779B97F4A7C15)
#: Bits of a chunk's digest that are counted; a chance match only compares passages in vain.
_ANCHOR = np.uint64((1 << 48) - 1)
#: Stands for a null document number: it comes first.
_NULL = -(2**63)


def _grams(word: np.ndarray, size: int, step: np.uint64 = _STEP) -> np.ndarray:
    """A hash of each ``size`` words in a row, wherever texts end."""
    out = np.zeros(max(0, len(word) - size + 1), np.uint64)
    for j in range(size if len(out) else 0):
        out = out * step + word[j : j + len(out)]
    return _mix(out)


def chunk_words(least: int) -> int:
    """Words that a chunk has at least, so that a passage of ``least`` words holds a whole one."""
    if least < 4 * SPREAD - 1:
        raise ValueError(f"a passage has {4 * SPREAD - 1} words or more")
    return min(max(1, (least - 2 * SPREAD) // 3), least - 4 * SPREAD + 2)


def chunk_digests(word: np.ndarray, low: int) -> np.ndarray:
    """For each boundary of words the digest of the chunk that begins there; the largest number where none does."""
    begin, size = word_chunks(word, low)
    out = np.full(max(0, len(word) - 1), ~np.uint64(0))
    for n in range(low, low + SPREAD):
        of_size = begin[size == n]
        if len(of_size):
            out[of_size] = _grams(word, n)[of_size + 1]
    return out


def passages(data: np.ndarray, ends: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, place (a word's number), hash, its check and anchor of each ``least`` words in a row of each text.

    The anchor is the smallest digest of the chunks that the passage's words
    alone decide: those that begin and end ``SPREAD`` boundaries from its edges.
    """
    starts, stops, text = words_of(data, ends)
    word = hash_words(data, starts, stops)
    whole, check = _grams(word, least), _grams(word, least, _CHECK)
    n, low = len(whole), chunk_words(least)
    digest = chunk_digests(word, low)
    anchor = np.full(n, ~np.uint64(0))
    for j in range(SPREAD - 1, least - 2 * SPREAD - low + 1 if n else 0):
        np.minimum(anchor, digest[j : j + n], out=anchor)
    inside = text[:n] == text[least - 1 :] if n else np.zeros(0, bool)
    owner = text[:n][inside]
    return owner, np.flatnonzero(inside) - np.searchsorted(text, owner), whole[inside], check[inside], anchor[inside]


def _anchor_rows(text: str, least: int):
    """A row per anchor: hash and document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            owner, _, _, _, anchor = passages(*text_buffer(batch.column(text)), least)
            new = np.ones(len(owner), bool)
            new[1:] = (owner[1:] != owner[:-1]) | (anchor[1:] != anchor[:-1])
            yield pa.RecordBatch.from_arrays([pa.array((anchor[new] & _ANCHOR).view(np.int64)), batch.column("_doc").take(pa.array(owner[new]))], names=["_anchor", "_doc"])

    return run


def _words(hashes: DataFrame, name: str, bits: int = FILTER_BITS) -> DataFrame:
    """A bit array of fixed size, set at each hash: at most 2^(bits - 6) rows of a ``_word``'s number and its 64 bits ``_set``.

    A passage that meets a set bit by chance is compared in vain: a small array
    costs time and changes no result.
    """
    slot = F.col(name).bitwiseAND((1 << bits) - 1)
    return hashes.groupBy(F.shiftright(slot, 6).alias("_word")).agg(F.bit_or(F.expr(f"shiftleft(1L, CAST({name} & 63 AS INT))")).alias("_set"))


def _bits(words: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """The bit array of ``_words`` as an array."""
    rows = words.toArrow()  # at most 2^(bits - 6) rows
    out = np.zeros(1 << (bits - 6), np.int64)
    out[rows.column("_word").to_numpy()] = rows.column("_set").to_numpy()
    return out.view(np.uint64)


def _likely(rows: DataFrame, name: str, words: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """The rows whose hash has its bit set in ``_words``; the array has a fixed size, and each task gets it."""
    number, flags = free_name(rows, "_word"), free_name(rows, "_set")
    word = F.shiftright(F.col(name).bitwiseAND((1 << bits) - 1), 6)
    met = rows.join(F.broadcast(words.toDF(number, flags)), word == F.col(number))
    return met.filter(F.expr(f"getbit({flags}, CAST({name} & 63 AS INT)) = 1")).select(*rows.columns)


def _held(hashes: np.ndarray, bits: np.ndarray) -> np.ndarray:
    slot = hashes & np.uint64(64 * len(bits) - 1)
    return (bits[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) == 1


def _sampled(digest: np.ndarray) -> np.ndarray:
    return digest % np.uint64(SAMPLE) == 0


def _passage_rows(text: str, least: int, chosen, columns: tuple[str, ...]):
    """A row per passage that ``chosen(batch, owner, place, digest, anchor)`` marks: its hash, columns of the batch, place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            found = passages(*text_buffer(batch.column(text)), least)
            owner, place, digest, _, anchor = found
            hit = chosen(batch, owner, place, digest, anchor)
            owner, place, digest, check, _ = (x[hit] for x in found)
            rows = pa.array(owner)
            yield pa.RecordBatch.from_arrays(
                [pa.array(digest.view(np.int64)), pa.array((check >> np.uint64(32)).astype(np.uint32).view(np.int32)), *(batch.column(c).take(rows) for c in columns), pa.array(place.astype(np.int32))],
                names=["_digest", "_check", *columns, "_seq"])

    return run


def _open(least: int, shared):
    """Passages with a shared anchor, some word of which is in no passage of ``_repeats``."""

    def chosen(batch, owner, place, digest, anchor):
        have = np.searchsorted(owner, np.arange(batch.num_rows + 1))
        hit = _held(anchor, shared.value) & ~_sampled(digest)
        for i, seen in enumerate(batch.column("_repeats")):
            own = slice(have[i], have[i + 1])
            if not seen.is_valid or not hit[own].any():
                continue
            n = have[i + 1] - have[i] + least - 1
            first = seen.values.to_numpy(zero_copy_only=False)[0::2]
            edge = np.bincount(first, minlength=n + 1) - np.bincount(first + least, minlength=n + 1)
            bare = np.concatenate([[0], np.cumsum(np.cumsum(edge[:n]) == 0)])
            hit[own] &= bare[least:] > bare[: len(bare) - least]
        return hit

    return chosen


def _listed(hits: DataFrame) -> DataFrame:
    """``_row`` and ``_repeats``: place and first document of each repeated passage, one after the other."""
    # A set: equal rows of one document find the same passages, and add nothing to each other's list.
    lists = hits.groupBy("_row").agg(F.collect_set(F.array(F.col("_seq").cast("bigint"), "_first")).alias("_list"))
    return lists.select("_row", F.flatten("_list").alias("_repeats"))


def _mapped(keyed: DataFrame, hits: DataFrame, run, schema: str) -> DataFrame:
    """``run`` over the batches of ``keyed`` with ``_repeats``, null where ``hits`` has nothing of a row.

    Most texts repeat nothing. Only rows whose bit is set are shuffled with
    their texts to meet the lists; the others are read where they stand. A bit
    that is set by chance sends a row the longer way.
    """
    words = materialise(_words(hits, "_row"), "substring-rows")
    bits = keyed.sparkSession.sparkContext.broadcast(_bits(words))

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = batch.column("_row").to_numpy(zero_copy_only=False).view(np.uint64)
            batch = batch.filter(pa.array(~_held(row, bits.value)))
            yield batch.append_column("_repeats", pa.nulls(batch.num_rows, pa.list_(pa.int64())))

    met = _likely(keyed, "_row", words).join(_listed(hits), "_row", "left").select(*keyed.columns, "_repeats")
    return met.mapInArrow(run, schema).union(keyed.mapInArrow(lambda batches: run(others(batches)), schema))


def _repeated(keyed: DataFrame, text: str, least: int) -> DataFrame:
    """``_row``, ``_seq`` and ``_first`` of passages that, all together, cover each repeated word."""
    context = keyed.sparkSession.sparkContext
    anchors = keyed.select("_doc", text).mapInArrow(_anchor_rows(text, least), "_anchor bigint, _doc bigint")
    both = anchors.groupBy("_anchor").agg(F.min("_doc").alias("_first"), F.max("_doc").alias("_last")).filter("_first < _last")
    shared = context.broadcast(_bits(_words(both, "_anchor")))
    key, hash_columns = ["_digest", "_check"], "_digest bigint, _check int"
    schema = f"{hash_columns}, _doc bigint, _row bigint, _seq int"

    def sampled(batch, owner, place, digest, anchor):
        return _sampled(digest) & _held(anchor, shared.value)

    found = materialise(keyed.select("_doc", "_row", text).mapInArrow(_passage_rows(text, least, sampled, ("_doc", "_row")), schema), "substring-sample")
    # Summed within each task first: a passage in a third of all documents is one row a task.
    firsts = found.groupBy(*key).agg(F.min("_doc").alias("_first"), F.max("_doc").alias("_last")).filter("_first < _last").drop("_last")
    # As a table: Spark can then split the rows of such a passage in the join.
    firsts = materialise(firsts, "substring-firsts")
    hits = materialise(found.join(firsts, key).filter("_doc > _first").select("_row", "_seq", "_first"), "substring-hits")

    opened = _passage_rows(text, least, _open(least, shared), ("_doc", "_row"))
    left = materialise(_mapped(keyed.select("_doc", "_row", text), hits, opened, schema), "substring-open")
    wanted = context.broadcast(_bits(_words(left, "_digest")))

    def asked(batch, owner, place, digest, anchor):
        return _held(digest, wanted.value) & _held(anchor, shared.value) & ~_sampled(digest)

    holders = keyed.select("_doc", text).mapInArrow(_passage_rows(text, least, asked, ("_doc",)), f"{hash_columns}, _doc bigint, _seq int")
    firsts = holders.groupBy(*key).agg(F.min("_doc").alias("_first"), F.max("_doc").alias("_last")).filter("_first < _last").drop("_last")
    firsts = materialise(firsts, "substring-firsts")
    more = _likely(left, "_digest", _words(firsts, "_digest")).join(firsts, key).filter("_doc > _first").select("_row", "_seq", "_first")
    return hits.union(materialise(more, "substring-hits"))


def _cut(raw: bytes, starts: np.ndarray, stops: np.ndarray, places: np.ndarray, least: int) -> tuple[str, list[dict]]:
    """What is left of a text, and the spans taken out in code points.

    ``starts`` and ``stops`` are the words' bytes; ``places`` the words where repeated passages begin, in order.
    White space goes with a passage at an edge of the text, and inside it.
    """
    gap = np.flatnonzero(places[1:] > places[:-1] + least)
    first = places[np.concatenate([[0], gap + 1])]
    last = places[np.concatenate([gap, [len(places) - 1]])] + least - 1
    begin = np.where(first == 0, 0, starts[first])
    end = np.where(last == len(stops) - 1, len(raw), stops[last])
    left, taken, at, points = [], [], 0, 0
    for a, b in zip(begin.tolist(), end.tolist()):
        left.append(raw[at:a].decode())
        points += len(left[-1])
        size = len(raw[a:b].decode())
        taken.append({"start": points, "end": points + size})
        at, points = b, points + size
    left.append(raw[at:].decode())
    return "".join(left), taken


def _cut_repeats(text: str, kept: list[str], least: int):
    """Take the repeated passages out of each text."""
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def rows(batch, texts, spans, sources):
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), texts, pa.array(spans, span), pa.array(sources, pa.list_(pa.int64()))],
                                          names=[*kept, text, "removed", "repeats_of"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            some = batch.column("_repeats").is_valid()
            whole = batch.filter(pc.invert(some))
            yield rows(whole, whole.column(text).cast(pa.string()), [[]] * whole.num_rows, [[]] * whole.num_rows)
            batch = batch.filter(some)
            data, ends = text_buffer(batch.column(text))
            starts, stops, owner = words_of(data, ends)
            upto = np.searchsorted(owner, np.arange(batch.num_rows + 1))
            texts, spans, sources = [], [], []
            for i, seen in enumerate(batch.column("_repeats")):
                own, begin = slice(upto[i], upto[i + 1]), int(ends[i])
                seen = seen.values.to_numpy(zero_copy_only=False)
                left, taken = _cut(data[begin : ends[i + 1]].tobytes(), starts[own] - begin, stops[own] - begin, np.unique(seen[0::2]), least)
                texts.append(left)
                spans.append(taken)
                sources.append([x for x in np.unique(seen[1::2]).tolist() if x != _NULL])
            yield rows(batch, pa.array(texts, pa.string()), spans, sources)

    return run


def drop_repeated_passages(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", carry: tuple[str, ...] = ("doc_id",), least_words: int = LEAST_WORDS) -> DataFrame:
    """Carried columns, ``text`` without repeated passages, ``removed`` spans, ``repeats_of``.

    A passage is ``least_words`` words in a row or more (11 at least), whatever
    ASCII white space parts them; it is repeated if an earlier document holds it. Every
    word of such a passage goes. Spans are code points of the text as it was,
    ends exclusive; ``repeats_of`` lists the documents that hold the first
    occurrences of passages that together cover what goes. The first occurrence is in the document with the smallest
    integer ``doc_id`` (null before all). Rows of one ``doc_id`` are one
    document: none repeats the other, and a passage that stands twice in one
    document stays. Null texts stay null; empty and short texts stay as they
    are. An empty table gives no rows. A carried column with the name of a
    result, or of ``_doc``, ``_row`` and ``_repeats``, gives way.
    """
    own = {text, "removed", "repeats_of", "_repeats", "_doc", "_row"}
    names = [c for c in dict.fromkeys(carry) if c not in own]
    number = F.coalesce(F.col(doc_id).cast("bigint"), F.lit(_NULL))
    keyed = docs.select(*names, text, number.alias("_doc"), F.xxhash64(number, F.col(text)).alias("_row"))
    repeats = _repeated(keyed, text, least_words)
    order = [c for c in keyed.columns if c in names]
    kept = arrow_schema(keyed, order)
    schema = f"{kept}{', ' if kept else ''}`{text}` string, removed array<struct<start:int,end:int>>, repeats_of array<bigint>"
    return _mapped(keyed.select(*order, text, "_row"), repeats, _cut_repeats(text, order, least_words), schema)
