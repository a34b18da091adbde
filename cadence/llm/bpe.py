"""BPE encoding and decoding with content-defined chunk reuse.

Texts are cut into chunks by a rolling hash. Chunks that occur more than once
in the corpus are encoded once each; the documents that hold them fetch their
ids by digest and join them with the chunks of their own. At each join the
word that the cut went through is encoded anew, and the window grows over
chunks that have no white space, until what is left of the chunks' ids is
exactly what the whole text gives: the tokenizer parts at white space, so ids
on either side of it are final.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm.chunks import chunk_ends
from cadence.llm.common import arrow_schema, materialise, row_id, slices, text_buffer
from cadence.llm.tokens import Encoder, encoder

#: Expected, least and largest bytes of a chunk: 2^CHUNK_BITS + least.
CHUNK_BITS, CHUNK_LOW, CHUNK_HIGH = 9, 128, 8192
#: Bits of the filter of repeated chunks that each executor gets: 8 MB, whatever the corpus.
FILTER_BITS = 26


#: Bytes before a chunk's first white space, ids up to its last, bytes after it.
Part = tuple[bytes, bytes, bytes | None]


def _chunks(column: pa.Array) -> tuple[list[bytes], list[int]]:
    data, ends = text_buffer(column)
    cut, upto = chunk_ends(data, ends, CHUNK_BITS, CHUNK_LOW, CHUNK_HIGH)
    raw = data.tobytes()
    return [raw[a:b] for a, b in zip([0, *cut], cut)], upto


def _digests(chunks: list[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(c) for c in chunks], np.uint64)


def _digest_rows(text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            yield pa.RecordBatch.from_arrays([pa.array(_digests(_chunks(batch.column(text))[0]).view(np.int64))], names=["digest"])

    return run


def repeated_filter(docs: DataFrame, text: str, bits: int = FILTER_BITS) -> np.ndarray:
    """A bit array of fixed size, set at the digest of each chunk that occurs twice or more.

    A chunk that meets a set bit by chance is only taken for a repeated one:
    it is then looked up like these, with the same result.
    """
    digests = docs.select(text).mapInArrow(_digest_rows(text), "digest bigint").groupBy("digest").agg(F.count("*").alias("n")).filter("n > 1")
    slot = F.col("digest").bitwiseAND((1 << bits) - 1)
    words = (digests.groupBy(F.shiftright(slot, 6).alias("word"))
             .agg(F.bit_or(F.expr(f"shiftleft(1L, CAST(digest & 63 AS INT))")).alias("set")))
    out = np.zeros(1 << (bits - 6), np.int64)
    rows = words.toPandas()  # at most 2^(bits - 6) rows
    out[rows.word.to_numpy(np.int64)] = rows["set"].to_numpy(np.int64)
    return out.view(np.uint64)


def _hits(digests: np.ndarray, repeated: np.ndarray, bits: int) -> np.ndarray:
    slot = digests & np.uint64((1 << bits) - 1)
    return (repeated[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) == 1


#: White space at which the tokenizer always parts.
_SPACE = re.compile(rb"[ \n\t\r]")


def _parts(enc: Encoder, chunks: list[bytes]) -> list[Part]:
    """Head, ids of what lies between, and tail of each chunk; no tail where there is no white space."""
    cuts = []
    for c in chunks:
        first = _SPACE.search(c)
        cuts.append((first.start(), max(c.rfind(x) for x in (b" ", b"\n", b"\t", b"\r"))) if first else None)
    inner = enc.encode_all([c[at[0] : at[1]] if at else b"" for c, at in zip(chunks, cuts, strict=True)])
    return [(c[: at[0]], ids, c[at[1] + 1 :]) if at else (c, b"", None) for c, at, ids in zip(chunks, cuts, inner, strict=True)]


def _joined(enc: Encoder, texts: list[list[Part]]) -> list[bytes]:
    """Ids of whole texts from their chunks' parts, with the words at the joins encoded anew."""
    bodies: list[list[bytes]] = []
    windows: list[bytes] = []
    for parts in texts:
        body, pending = [], b""
        for head, ids, tail in parts:
            pending += head
            if tail is not None:
                windows.append(pending)
                body.append(ids)
                pending = tail
        windows.append(pending)
        bodies.append(body)
    mended = iter(enc.encode_all(windows))
    out = []
    for body in bodies:
        ids = [next(mended)]
        for between in body:
            ids += [between, next(mended)]
        out.append(b"".join(ids))
    return out


def _result(enc: Encoder, carried: list[pa.Array], names: list[str], ids: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [*carried, pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary()), pa.array([enc.decode(x) for x in ids], pa.string())],
        names=[*names, "n_tokens", "ids", "decoded"])


def _encode_own(tokenizer: str, text: str, names: list[str], repeated, bits: int):
    """Whole results of the documents that hold no repeated chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for batch in slices(batches, text):
            chunks, upto = _chunks(batch.column(text))
            hit = np.concatenate([[0], np.cumsum(_hits(_digests(chunks), repeated.value, bits))])
            own = [i for i in range(batch.num_rows) if hit[upto[i]] == hit[upto[i + 1]]]
            parts = _parts(enc, [chunks[k] for i in own for k in range(upto[i], upto[i + 1])])
            ids, at = [], 0
            for i in own:
                n = upto[i + 1] - upto[i]
                ids.append(parts[at : at + n])
                at += n
            ids = _joined(enc, ids)
            rows = pa.array(own, pa.int64())
            yield _result(enc, [batch.column(c).take(rows) for c in names], names, ids)

    return run


def _piece_rows(tokenizer: str, text: str, row: str, names: list[str], repeated, bits: int):
    """Chunks of the documents that hold a repeated one: that one's digest (and text, once a batch), or parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for batch in slices(batches, text):
            chunks, upto = _chunks(batch.column(text))
            hit = _hits(_digests(chunks), repeated.value, bits)
            total = np.concatenate([[0], np.cumsum(hit)])
            docs = [i for i in range(batch.num_rows) if total[upto[i]] < total[upto[i + 1]]]
            at = [(i, k) for i in docs for k in range(upto[i], upto[i + 1])]
            parts = iter(_parts(enc, [chunks[k] for _, k in at if not hit[k]]))
            sent: set[bytes] = set()
            columns: list[list] = [[] for _ in range(5)]
            for _, k in at:
                digest = xxhash.xxh3_128_digest(chunks[k]) if hit[k] else None
                shown = chunks[k] if digest is not None and digest not in sent else None
                sent.add(digest)
                for column, x in zip(columns, (digest, shown, *((None, None, None) if hit[k] else next(parts))), strict=True):
                    column.append(x)
            rows = pa.array([i for i, _ in at], pa.int64())
            seq = pa.array([k - upto[i] for i, k in at], pa.int32())
            kinds = (pa.binary(),) * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column(row).take(rows), seq, *[batch.column(c).take(rows) for c in names], *[pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]],
                names=["_row", "_seq", *names, "_digest", "_text", "_head", "_inner", "_tail"])

    return run


def _encode_shared(tokenizer: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for batch in batches:
            parts = _parts(enc, batch.column("_text").to_pylist())
            head, inner, tail = zip(*parts, strict=True) if parts else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column("_digest"), *[pa.array(x, pa.binary()) for x in (head, inner, tail)]],
                                             names=["_digest", "_head", "_inner", "_tail"])

    return run


def _assemble(tokenizer: str, names: list[str]):
    """Documents from their chunks, which come one after another, in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        row, carried, parts, types = None, None, [], None
        done: list[tuple[tuple, list]] = []
        size = 0

        def flush():
            ids = _joined(enc, [p for _, p in done])
            arrays = [pa.array([c[i] for c, _ in done], t) for i, t in enumerate(types)]
            return _result(enc, arrays, names, ids)

        for batch in batches:
            types = [batch.column(c).type for c in names]
            columns = [batch.column(c).to_pylist() for c in ("_row", "_head", "_inner", "_tail", *names)]
            for key, head, inner, tail, *kept in zip(*columns, strict=True):
                if key != row:
                    if parts:
                        done.append((carried, parts))
                    if size > 4 << 20:
                        yield flush()
                        done, size = [], 0
                    row, carried, parts = key, kept, []
                parts.append((head, inner, tail))
                size += len(inner)
        if parts:
            done.append((carried, parts))
        if done:
            yield flush()

    return run


def encode_documents(docs: DataFrame, tokenizer: str, text: str = "text", carry: tuple[str, ...] = ("doc_id",), filter_bits: int = FILTER_BITS) -> DataFrame:
    """Carried columns, ``n_tokens``, ``ids`` and ``decoded`` of every whole text.

    ``ids`` are little-endian unsigned 32-bit integers, equal to the library's
    for the whole text without special tokens; ``decoded`` is the library's
    text of them, special tokens included. A null text counts as empty and has
    no ids. Repeated rows are encoded like any and each give a row. The
    tokenizer must drop white space (word-end vocabularies). Carried columns
    with the name of a result, or of ``_row``, ``_seq``, ``_digest``,
    ``_text``, ``_head``, ``_inner`` and ``_tail``, give way.
    """
    own = {"n_tokens", "ids", "decoded", "_row", "_seq", "_digest", "_text", "_head", "_inner", "_tail"}
    rows = docs.select(text, *[c for c in carry if c != text and c not in own])
    names = [c for c in rows.columns if c in carry and c not in own]
    kept = arrow_schema(rows, names)
    kept = kept + ", " if kept else ""
    if encoder(tokenizer).spaced:
        raise ValueError("the tokenizer keeps white space; chunks can be joined only where it is dropped")
    repeated = docs.sparkSession.sparkContext.broadcast(repeated_filter(docs, text, filter_bits))
    result = f"{kept}n_tokens bigint, ids binary, decoded string"
    alone = rows.mapInArrow(_encode_own(tokenizer, text, names, repeated, filter_bits), result)
    pieces = materialise(rows.withColumn("_row", row_id()).mapInArrow(
        _piece_rows(tokenizer, text, "_row", names, repeated, filter_bits),
        f"_row bigint, _seq int, {kept}_digest binary, _text binary, _head binary, _inner binary, _tail binary"), "bpe-pieces")
    shared = (pieces.filter("_text IS NOT NULL").groupBy("_digest").agg(F.first("_text").alias("_text"))
              .mapInArrow(_encode_shared(tokenizer), "_digest binary, _head binary, _inner binary, _tail binary"))
    fields = ["_row", "_seq", *names, "_head", "_inner", "_tail"]
    looked_up = pieces.filter("_digest IS NOT NULL").drop("_text", "_head", "_inner", "_tail").join(shared, "_digest").select(*fields)
    parts = pieces.filter("_digest IS NULL").select(*fields).unionByName(looked_up)
    joined = parts.repartition("_row").sortWithinPartitions("_row", "_seq").mapInArrow(_assemble(tokenizer, names), result)
    return alone.unionByName(joined)
