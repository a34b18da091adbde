"""Sharding, the pipeline, and what keeps the subpackage apart."""

import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from cadence.llm import packing, queries, sharding
from tests.conftest import SF_SMALL
from tests.llm.tables import awkward, clashing, documents, prose, row
from tests.llm.test_dedup import brute_classes
from tests.llm.test_filters import SECRETS, measured, scanned
from tests.llm.test_tokens import BYTE, check_packed, library, plain


def smallest(sizes, shards):
    """Least capacity by plain search over all cut sums."""
    low, high = max([*sizes, -(-sum(sizes) // shards)]), sum(sizes)
    while low < high:
        capacity, used, fill = (low + high) // 2, 1, 0
        for s in sizes:
            used, fill = (used, fill + s) if fill + s <= capacity else (used + 1, s)
        low, high = (low, capacity) if used <= shards else (capacity + 1, high)
    return low


def check_shards(rows, n):
    for k in {r.shard for r in rows}:
        assert 0 <= k < n and sorted(r.slot for r in rows if r.shard == k) == list(range(sum(r.shard == k for r in rows)))


@pytest.mark.parametrize("n", [1, 3, 24])
def test_capacity_is_the_smallest(spark, n, monkeypatch):
    monkeypatch.setattr(sharding, "FIRST_BITS", 3)  # so that a few groups need refinement
    monkeypatch.setattr(sharding, "MORE_BITS", 2)
    rows = awkward() + [row(200 + k, prose(1 + k * 7 % 50, k % 90)) for k in range(400)]
    docs = clashing(documents(spark, rows), ["shard", "slot", "size", "_key", "_row"])
    kept = docs.withColumn("hash", F.xxhash64(F.col("text").isNull(), "text"))
    got = sharding.shard_documents(kept, n, carry=("doc_id", "hash", "_key")).collect()
    assert len(got) == len(rows)
    check_shards(got, n)
    sizes, load, where = {}, {}, {}
    for r in got:
        sizes[r.hash] = sizes.get(r.hash, 0) + r.size
        load[r.shard] = load.get(r.shard, 0) + r.size
        assert where.setdefault(r.hash, r.shard) == r.shard
    ordered = [sizes[k] for k in sorted(sizes)]
    assert max(load.values()) == smallest(ordered, n)
    assert [where[k] for k in sorted(where)] == sorted(where[k] for k in where)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(8, 3000), min_size=1, max_size=120), st.integers(1, 9))
def test_bounds_meet_on_known_ends(sizes, shards):
    ends = np.concatenate([[0], np.cumsum(sizes)])
    s = sharding.Summary(np.arange(len(sizes)), np.array(sizes), np.ones(len(sizes), bool), np.arange(len(sizes)), np.full(len(sizes), 64))
    sure = sharding._smallest(lambda c: sharding._cuts(ends, c, shards)[-1] == len(sizes), -(-sum(sizes) // shards), sum(sizes))
    best = sharding._smallest(lambda c: sharding._reach(s, ends, c, shards)[-1] >= ends[-1], -(-sum(sizes) // shards), sure)
    assert best == sure == smallest(sizes, shards)


def test_op9_contract(spark):
    rows = queries.op9_minimax_shards(spark, SF_SMALL).collect()
    texts = {r.doc_id: r.text for r in queries.table(spark, SF_SMALL, "documents").collect()}
    check_shards(rows, 24)
    assert len(rows) == len(texts) and {r.law for r in rows} == {"bytes"} and {r.grown_shard for r in rows} == {None}
    for r in rows:
        assert r.size == len(texts[r.doc_id].encode()) + 8 and r.text_crc32 == zlib.crc32(texts[r.doc_id].encode())


def test_sharding_empty(spark):
    assert sharding.shard_documents(documents(spark, [])).count() == 0




@pytest.fixture(scope="module")
def staged(spark):
    """Each stage's input and output over the small table with awkward rows."""
    import tempfile

    base = queries.table(spark, "/root/testdata/sf0.01", "documents")
    extra = documents(spark, awkward() + SECRETS).withColumn("doc_id", F.col("doc_id") + 10**6)
    docs = base.union(extra.select(*base.columns)).withColumns({c: F.lit("clash") for c in ("kept", "_node", "_site", "ids")})
    folder, out = tempfile.mkdtemp(prefix="stages-"), {}
    docs.write.parquet(f"{folder}/in")
    docs = spark.read.parquet(f"{folder}/in")
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, "").write.parquet(f"{folder}/{name}")
        after = spark.read.parquet(f"{folder}/{name}")
        out[name] = docs, after
        docs = after
    return out


def test_stage_quality(spark, staged):
    before, after = staged["quality_rules"]
    assert after.columns == before.columns
    kept = {r.doc_id: r.text for r in after.collect()}
    labels = {r.doc_id: r.quality for r in queries.table(spark, "/root/testdata/sf0.01", "labels").collect()}
    failed = {r.doc_id for r in before.collect() if measured(r.text)[-1]}
    assert not failed & kept.keys()
    judged = [d for d in labels if d not in failed]
    assert np.mean([(d in kept) == (labels[d] == 1) for d in judged]) >= 0.98
    assert all(kept[r.doc_id] == r.text for r in before.collect() if r.doc_id in kept and r.doc_id != 10**6 + 6)


def brute_lines(rows, ratio=0.05):
    """doc_id -> text without the lines over the ratio, near copies of a text counted once."""
    sites, gone, bare = {}, {}, " \t\r\f\x0b"
    for r in rows:
        sites.setdefault(r.source, set()).add(r.text)
    for site, texts in sites.items():
        own = {t: [x for x in dict.fromkeys(x.strip(bare) for x in (t or "").split("\n")) if x] for t in texts}

        def frequent(unit, own=own):
            held = {(unit(t), x) for t in own for x in own[t]}
            count = Counter(x for _, x in held)
            return {x for x, n in count.items() if n >= 2 and n > ratio * len({unit(t) for t in own})}

        common = frequent(lambda t: t)
        copies = {t: max((x for x in xs if x in common), key=len) for t, xs in own.items()
                  if xs and any(x in common for x in xs) and sum(len(x) for x in xs if x in common) >= 0.8 * sum(map(len, xs))}
        longest = {x: max(len(copies[t]) for t in copies if x in own[t]) for x in {x for t in copies for x in own[t]}}
        gone[site] = frequent(lambda t: longest[copies[t]] if t in copies else (t,))
    out = []
    for r in rows:
        left = [x for x in (r.text or "").split("\n") if x.strip(" \t\r\f\x0b") not in gone[r.source]]
        out.append((str(r.doc_id), str(r.text) if r.text is None or not any(x.strip(" \t\r\f\x0b") for x in left) else "\n".join(left)))
    return sorted(out)


def test_stage_lines(spark, staged):
    before, after = staged["line_dedup"]
    assert after.columns == before.columns
    assert sorted((str(r.doc_id), str(r.text)) for r in after.collect()) == brute_lines(before.collect())
    assert after.filter(F.col("n_chars") != F.length("text")).count() == 0


def test_stage_near_copies(spark, staged):
    before, after = staged["near_dedup"]
    assert after.columns == before.columns
    rows = [(r.doc_id, r.text) for r in before.collect()]
    first = {d for d, c in brute_classes(rows) if d == c}
    got = [str(r.doc_id) for r in after.collect()]
    assert sorted(got) == sorted(first)


def test_stage_secrets(spark, staged):
    before, after = staged["secret_scan"]
    assert after.columns == before.columns and after.count() == before.count()
    texts = {r.doc_id: r.text for r in after.collect()}
    for r in before.collect():
        assert ("[SECRET]" in texts[r.doc_id]) if scanned(r.text) else texts[r.doc_id] == r.text


def test_stage_packing(spark, staged):
    before, after = staged["packing"]
    rows = after.collect()
    check_packed(rows)
    tokenizer = library(BYTE)
    want = sorted((str(r.doc_id), b"".join(x.to_bytes(4, "little") for x in [*plain(tokenizer, r.text), 2])) for r in before.collect())
    got = {}
    for r in sorted(rows, key=lambda r: r.start):
        got[str(r.doc_id)] = got.get(str(r.doc_id), b"") + bytes(r.ids)
    assert sorted(got.items()) == want


def test_run_equals_the_stages(spark):
    rows = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert check_packed(rows) > 0 and packing.RESULT[0] in rows[0].__fields__


def test_pipeline_on_an_empty_table(spark, tmp_root):
    documents(spark, []).write.parquet(f"{tmp_root}/documents.parquet")
    assert corpus_pipeline.run(spark, tmp_root).count() == 0
