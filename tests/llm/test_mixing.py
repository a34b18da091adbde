"""The mix against plain Python: targets, draws, permutations, and the words themselves."""

import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from cadence.llm import mixing, oracle, queries
from tests.conftest import SF_SMALL
from tests.llm.tables import awkward, clashing, documents, prose, row

WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


def plain_targets(sizes):
    """Share by weight, cut at twice the size, share the excess anew."""
    names = sorted((x for x in sizes if x is not None), key=lambda x: x.encode()) + [None] * (None in sizes)
    weight = {x: (3, 1, 2)[k % 3] for k, x in enumerate(names)}
    target, free, rest = dict.fromkeys(names, 0.0), list(names), 1.5 * sum(sizes.values())
    while rest > 1e-9 and free:
        total = sum(weight[x] for x in free)
        for x in free:
            target[x] += rest * weight[x] / total
        rest = sum(max(0.0, target[x] - 2 * sizes[x]) for x in names)
        target = {x: min(target[x], 2.0 * sizes[x]) for x in names}
        free = [x for x in free if target[x] < 2 * sizes[x]]
    return target


def many(n=400):
    return awkward() + [row(500 + k, prose(3 + 13 * k % 90, k), (None, "b", "hot", "hot", "hot", "é", "z", "")[k % 8]) for k in range(n)]


@pytest.mark.parametrize(("block", "shard"), [(512, 1024), (7, 16)])
def test_words_taken(spark, block, shard):
    rows = many()
    docs = clashing(documents(spark, rows), ["size", "taken", "block", "_row", "target", "number"])
    got = mixing.taken(mixing.mix(docs, F.col("source"), block=block, shard=shard)).collect()
    size = {s: sum(len(WORDS.findall((r[1] or "").encode())) for r in rows if r[3] == s) for s in {r[3] for r in rows}}
    want = plain_targets(size)
    assert Counter((r.doc_id, r.size) for r in got) == Counter((r[0], len(WORDS.findall((r[1] or "").encode()))) for r in rows)
    assert all(0 <= r.taken <= 2 * r.size for r in got)
    by_target = Counter()
    for r in got:
        by_target[round(r.target, 4)] += r.taken
    assert len(set(map(lambda x: round(x, 4), want.values()))) == len(by_target)
    for target, words in by_target.items():
        assert abs(words - target) <= 1
    assert {round(r.target, 4) for r in got} == {round(x, 4) for x in want.values()}
    again = mixing.taken(mixing.mix(docs.repartition(5), F.col("source"), block=block, shard=shard)).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, got))


def test_slots_and_permutations(spark):
    m = mixing.mix(documents(spark, many()), F.col("source"), block=5, shard=64)
    slots = m.slots.collect()
    per_source = {}
    for r in slots:
        per_source.setdefault(r.number, []).append(r)
    for own in per_source.values():
        assert sorted(r["index"] for r in own) == list(range(len(own)))
        assert max(Counter(r.block for r in own).values()) <= 2
    # A shard's counts vary around its sources' shares as a multinomial draw's do.
    hot = max(per_source, key=lambda k: len(per_source[k]))
    p = len(per_source[hot]) / len(slots)
    counts = Counter(r.shard for r in slots if r.number == hot)
    shards = max(r.shard for r in slots)
    assert all(sum(r.shard == k for r in slots) == 64 for k in range(shards))
    z = [(counts[k] - 64 * p) / (64 * p * (1 - p)) ** 0.5 for k in range(shards)]
    assert 0.5 < sum(x * x for x in z) / len(z) < 1.7
    # One round's blocks are a permutation, and not the order of the words.
    full = max(r.block for r in per_source[hot])
    first = [r.block for r in sorted(per_source[hot], key=lambda r: r["index"])][: full + 1]
    assert len(set(first)) == len(first) and first != sorted(first)
    assert sum(a + 1 == b for a, b in zip(first, first[1:], strict=False)) < len(first) / 10


def test_swap_or_not_is_a_permutation(spark):
    keys = F.array(*[F.lit(k * 7919 + 13).cast("bigint") for k in range(24)])
    for n in (1, 2, 37, 500):
        got = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("bigint"), keys).alias("p")).collect()
        assert sorted(r.p for r in got) == list(range(n))


def test_blocks_hold_the_words(spark):
    rows = [row(k, prose(1 + 37 * k % 150, k), "abc"[k % 3]) for k in range(90)] + [row(200, None), row(201, " \n ")]
    docs = documents(spark, rows)
    got = mixing.mixed_blocks(docs, F.col("source"), block=32, shard=8).collect()
    words = {r[0]: [w.decode() for w in WORDS.findall((r[1] or "").encode())] for r in rows}
    taken = Counter()
    for r in got:
        want = [w for x in r.pieces for w in words[x.doc_id][x.word : x.word + x.n_words]]
        assert r.text == " ".join(want) and r.n_words == len(want) <= 32
        for x in r.pieces:
            taken[x.doc_id] += x.n_words
    summed = {r.doc_id: r.taken for r in mixing.taken(mixing.mix(docs, F.col("source"), block=32, shard=8)).collect()}
    assert {k: v for k, v in summed.items() if v} == dict(taken)
    for shard in {r.shard for r in got}:
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(sum(r.shard == shard for r in got)))


def test_empty_tables(spark):
    assert mixing.taken(mixing.mix(documents(spark, []), F.col("source"))).count() == 0
    got = mixing.taken(mixing.mix(documents(spark, [row(1, None), row(2, "")]), F.col("source"))).collect()
    assert [(r.size, r.target, r.taken) for r in got] == [(0, 0.0, 0)] * 2


def test_query_against_sql(spark):
    got = queries.op11_multinomial_mix(spark, SF_SMALL).collect()
    db = duckdb.connect()
    db.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF_SMALL}/documents.parquet'")
    want = db.sql(oracle.SQL["op11_multinomial_mix"])
    assert sorted(map(tuple, got)) == sorted(tuple(dict(zip(want.columns, r))[c] for c in got[0].__fields__) for r in want.fetchall())
