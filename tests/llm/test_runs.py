"""Periodic runs against plain enumeration."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cadence.llm import queries, runs
from tests.conftest import SF_SMALL
from tests.llm.tables import awkward, by_id, clashing, documents, row


def brute_runs(words):
    """Every maximal stretch with smallest period q, by trying all periods in turn."""
    n, seen = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i + q - s
            if length >= max(6, 4 * q):
                seen.setdefault((s, length), q)
    return sorted((s, n, q) for (s, n), q in seen.items())


def found(words):
    return [tuple(x) for x in runs.runs_of([np.array(words, np.int64)])[0].tolist()]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=9), st.integers(1, 9)), max_size=9))
def test_runs_of_periodic_pieces(pieces):
    words = [w for unit, times in pieces for w in unit * times]
    assert found(words) == brute_runs(words)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 1), max_size=120), min_size=1, max_size=6))
def test_texts_do_not_touch(texts):
    got = runs.runs_of([np.array(t, np.int64) for t in texts])
    assert [[tuple(x) for x in r.tolist()] for r in got] == [brute_runs(t) for t in texts]


def test_common_prefixes_are_exact():
    rnd = random.Random(5)
    for alphabet, n in ((1, 300), (2, 500), (3, 64), (50, 900), (2, 1), (1, 33)):
        words = [rnd.randrange(alphabet) for _ in range(n)]
        if n > 400:
            words[200:400] = words[:200]
        at = runs.CommonPrefixes(np.append(np.array(words, np.int64), 999))
        i = np.array([rnd.randrange(n + 1) for _ in range(400)])
        j = np.array([rnd.randrange(n + 1) for _ in range(400)])
        i, j = i[i != j], j[i != j]
        want = []
        for a, b in zip(i.tolist(), j.tolist(), strict=True):
            k = 0
            while max(a, b) + k < n and words[a + k] == words[b + k]:
                k += 1
            want.append(k)
        assert at(i, j).tolist() == want


def test_every_difference_has_a_way():
    assert runs.WAY.max() < runs.COVER
    assert all(runs._MEMBER[(i + runs.WAY[i, j]) % runs.COVER] and runs._MEMBER[(j + runs.WAY[i, j]) % runs.COVER]
               for i in range(runs.COVER) for j in range(runs.COVER))


def test_long_runs_and_blocks_of_the_grid(monkeypatch):
    words = [1] * 5000 + [2, 3, 4] * 700 + list(range(10, 900)) * 5
    want = brute_runs(words)
    assert found(words) == want and (0, 5000, 1) in want
    monkeypatch.setattr(runs, "GRID", 64)
    assert found(words[:1500]) == brute_runs(words[:1500])


def plain_row(doc_id, text):
    """The contract in plain Python."""
    words = (text or "").encode().split()
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    number = {w: k for k, w in enumerate(dict.fromkeys(words))}
    all_runs = brute_runs([number[w] for w in words])
    gone = set()
    for s, length, q in all_runs:
        gone.update(range(s + q, s + length))
    left = b" ".join(w for i, w in enumerate(words) if i not in gone)
    best = min(all_runs, key=lambda x: (-x[1], x[0], x[2])) if all_runs else (None, None, None)
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in all_runs)
    return (doc_id, len(all_runs), *best, None if best[0] is None else 1000 * best[1] // best[2],
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(left).hexdigest())


COLUMNS = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_awkward_tables(spark):
    rows = [r if len(r[1] or "") < 9000 else (*r[:1], r[1][:9000], *r[2:]) for r in awkward()]
    rows += [row(30, "ho " * 400), row(31, "a b " * 90 + "c"), row(None, "x y z " * 30), row(44, "one two three four five six seven"), row(51, "k " * 5)]
    docs = clashing(documents(spark, rows), ["start", "runs", "collapsed", "length"])
    got = runs.periodic_runs(docs, stretch=True).collect()
    assert by_id(got, *COLUMNS) == sorted(tuple(str(x) for x in plain_row(*r[:2])) for r in rows)
    assert all(hashlib.sha256(r.collapsed.encode()).hexdigest() == r.collapsed_sha256 and len(r.runs) == r.n_runs for r in got)
    assert runs.periodic_runs(documents(spark, [])).count() == 0
    assert {r.collapsed for r in runs.periodic_runs(documents(spark, [row(1, "u v " * 9)])).collect()} == {"u v"}


@pytest.mark.parametrize("sf", [SF_SMALL])
def test_query_against_the_contract(spark, sf):
    got = queries.op13_periodic_runs(spark, sf).collect()
    docs = spark.read.parquet(f"{sf}/documents.parquet").where(F.length("text") < 20_000).collect()
    want = {r.doc_id: tuple(str(x) for x in plain_row(r.doc_id, r.text)) for r in docs}
    rows = {r.doc_id: tuple(str(getattr(r, c)) for c in ("doc_id", *COLUMNS)) for r in got}
    assert len(got) >= len(want) > 100 and all(rows[k] == v for k, v in want.items())
    assert sum(r.n_runs > 0 for r in got) >= len(got) // 20
