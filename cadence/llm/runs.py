"""Periodic run detection.

A run is a maximal stretch of words that repeats with its smallest period at
least ``EXPONENT`` times. Runs are found on a harmonic grid: for each period p,
places 2p apart; every run of that period covers such a place together with
the two periods after it. Where a few words there agree, the longest common
extensions to both sides (LCE) give the stretch.

LCE queries are answered by a difference cover: of each ``COVER`` places in a
row only those of the cover are sampled, and only sampled suffixes are sorted.
For any two places some distance below ``COVER`` leads to two sampled ones, so
a query compares fewer words than that and then takes a minimum over the
sorted samples' common prefixes from a sparse table.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cadence.llm.common import arrow_schema, slices, text_buffer

#: Fixed values of the definition: times that a run repeats its period, and words that it has at least.
EXPONENT, LEAST = 4, 6
#: A difference cover: every difference modulo COVER is one of two of its members.
COVER, MEMBERS = 31, (1, 5, 11, 24, 25, 27)
#: Places of the grid that are tried together.
GRID = 1 << 20

_MEMBER = np.zeros(COVER, bool)
_MEMBER[list(MEMBERS)] = True


def _ways() -> np.ndarray:
    """For two places modulo ``COVER`` the smallest distance to where both are members."""
    way = np.full((COVER, COVER), COVER, np.int64)
    for d in reversed(range(COVER)):
        here = np.roll(_MEMBER, -d)
        way[np.ix_(here, here)] = d
    return way


WAY = _ways()


def _named(*keys: np.ndarray) -> np.ndarray:
    """Numbers in the order of the keys' tuples; equal tuples have one number. Keys are below 2^31."""
    name = np.unique(keys[0], return_inverse=True)[1]
    for key in keys[1:]:
        name = np.unique((name.astype(np.int64) << 32) | key, return_inverse=True)[1]
    return name.astype(np.int64)


class CommonPrefixes:
    """How many words from places i and j on are the same, for arrays of places in ``words``.

    The last word must be one of its own, as must the word between two texts,
    so that no common stretch leaves a text.
    """

    def __init__(self, words: np.ndarray):
        n = len(words)
        self.words = np.concatenate([words, words.max() + 1 + np.arange(COVER + 1)]).astype(np.int64)
        self.samples = np.flatnonzero(_MEMBER[np.arange(n) % COVER])
        number = np.full(n + COVER + 1, -1, np.int64)
        number[self.samples] = np.arange(len(self.samples))
        # Sorted by the first COVER words, then by doubling over samples that many words further.
        first = _named(*(self.words[self.samples + k] for k in range(COVER)))
        levels, step = [first], COVER
        while len(self.samples) and step < n and levels[-1].max() + 1 < len(self.samples):
            later = self.samples + step
            follows = np.where(later < n, number[np.minimum(later, n)], -1)
            rank = np.where(follows < 0, 0, levels[-1][follows] + 1)
            levels.append(_named(levels[-1], rank))
            step *= 2
        order = np.argsort(levels[-1], kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        self.rank = np.full(n + COVER + 1, -1, np.int64)
        self.rank[self.samples] = rank
        self.least = [self._neighbours(order, levels, number, n)]
        while 2 << (len(self.least) - 1) <= len(self.least[0]):
            half, last = 1 << (len(self.least) - 1), self.least[-1]
            self.least.append(np.minimum(last[:-half], last[half:]))

    def _neighbours(self, order: np.ndarray, levels: list[np.ndarray], number: np.ndarray, n: int) -> np.ndarray:
        """Common words of each sorted sample with the one before it: whole levels first, then words."""
        a, b = self.samples[order[:-1]], self.samples[order[1:]]
        common = np.zeros(len(a), np.int64)
        for k in reversed(range(len(levels))):
            i, j = a + common, b + common
            inside = np.flatnonzero((i < n) & (j < n))
            same = inside[levels[k][number[i[inside]]] == levels[k][number[j[inside]]]]
            common[same] += COVER << k
        todo = np.arange(len(a))
        for _ in range(COVER):
            i, j = a[todo] + common[todo], b[todo] + common[todo]
            ok = (i < n) & (j < n)
            ok[ok] = self.words[i[ok]] == self.words[j[ok]]
            todo = todo[ok]
            common[todo] += 1
        return common.astype(np.int32)

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """i and j differ and lie below the number of words."""
        way = WAY[i % COVER, j % COVER]
        common = np.zeros(len(i), np.int64)
        todo = np.flatnonzero(way > 0)
        for k in range(COVER):
            todo = todo[self.words[i[todo] + k] == self.words[j[todo] + k]]
            common[todo] += 1
            todo = todo[way[todo] > k + 1]
        there = np.flatnonzero(common == way)
        r, s = self.rank[i[there] + way[there]], self.rank[j[there] + way[there]]
        found = (r >= 0) & (s >= 0)
        there, low, high = there[found], np.minimum(r, s)[found], np.maximum(r, s)[found]
        width = np.frexp((high - low).astype(float))[1] - 1
        for k in np.unique(width).tolist():
            at = np.flatnonzero(width == k)
            row = self.least[k]
            common[there[at]] += np.minimum(row[low[at]], row[high[at] - (1 << k)])
        return common


def _grid(n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Period and place of the grid of n words, in blocks."""
    p = np.arange(1, n // EXPONENT + 1)
    count = (n - 1 - 2 * p) // (2 * p) + 1
    done = np.cumsum(count)
    at = 0
    while at < len(p):
        base = done[at] - count[at]
        to = max(at + 1, int(np.searchsorted(done, base + GRID, "right")))
        period = np.repeat(p[at:to], count[at:to])
        yield period, 2 * period * (np.arange(len(period)) - np.repeat(done[at:to] - count[at:to] - base, count[at:to]))
        at = to


def candidates(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Periods and places of the grid at which a run may be: a few words agree with those a period on."""
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for p, i in _grid(len(words)):
        for part in (lambda q: 0, lambda q: q, lambda q: q // 2, lambda q: q // 3, lambda q: 2 * q // 3):
            ok = np.flatnonzero(words[i + part(p)] == words[i + part(p) + p])
            p, i = p[ok], i[ok]
        found.append((p, i))
    return np.concatenate([x[0] for x in found]), np.concatenate([x[1] for x in found])


def runs_of(texts: list[np.ndarray]) -> list[np.ndarray]:
    """For each text, given as numbers of words, rows (start, length, period) of its runs by start, then period."""
    none = np.zeros((0, 3), np.int64)
    found = [none] * len(texts)
    tried = [(k, *candidates(words)) for k, words in enumerate(texts)]
    tried = [(k, p, i) for k, p, i in tried if len(p)]
    if not tried:
        return found
    # All texts with candidates behind one another, a word of its own between them.
    size = np.array([len(texts[k]) + 1 for k, _, _ in tried])
    begin = np.concatenate([[0], np.cumsum(size)])
    most = max(int(texts[k].max()) for k, _, _ in tried) + 1
    joined = np.concatenate([np.append(texts[k], most + m) for m, (k, _, _) in enumerate(tried)])
    text = np.repeat(np.arange(len(tried)), [len(p) for _, p, _ in tried])
    p = np.concatenate([x for _, x, _ in tried])
    i = np.concatenate([x for _, _, x in tried]) + begin[text]
    after = CommonPrefixes(joined)(i, i + p)
    # The words before i: the words after, in the text turned round.
    total = len(joined)
    turned = CommonPrefixes(np.append(joined[::-1], joined.max() + 1))
    before = turned(total - i, total - i - p)
    start, length = i - before, before + p + after
    long = length >= np.maximum(LEAST, EXPONENT * p)
    text, start, length, p = text[long], start[long] - begin[text[long]], length[long], p[long]
    # One stretch is found with its smallest period and with multiples of it: the first stays.
    order = np.lexsort((p, length, start, text))
    text, start, length, p = text[order], start[order], length[order], p[order]
    first = np.ones(len(text), bool)
    first[1:] = (text[1:] != text[:-1]) | (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    rows, text = np.stack([start, length, p], 1)[first], text[first]
    for m in np.unique(text).tolist():
        own = rows[text == m]
        found[tried[m][0]] = own[np.lexsort((own[:, 2], own[:, 0]))]
    return found


def stretched(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """Words whose tail is made periodic in a tenth of the documents, by the checksum of their id."""
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a : a + p]
    return words[:a] + (unit * ((n - a) // p + 1))[: n - a]


def collapsed(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """The words without those that a run repeats: of each run the first period stays."""
    if not len(runs):
        return words
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return [words[k] for k in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]


#: Columns of the result beside the key, with their types in Arrow and in Spark.
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
RESULT = {**{c: (pa.int64(), "bigint") for c in ("n_runs", "start", "length", "period", "exponent_milli")},
          **{c: (pa.string(), "string") for c in ("runs_sha256", "collapsed_sha256", "collapsed")},
          "runs": (_RUNS, "array<struct<start: bigint, length: bigint, period: bigint>>")}


def periodic_runs(docs: DataFrame, text: str = "text", key: str = "doc_id", stretch: bool = False, whole: bool = True) -> DataFrame:
    """Per row ``key``, ``n_runs``, the longest run, all ``runs``, the text ``collapsed``, and digests of the last two.

    Words are parted by ASCII white space and compared as they are. The
    longest run's ``start``, ``length``, ``period`` and ``exponent_milli`` are
    null where there is none; ties go to the smallest start, then period.
    ``collapsed`` joins by single spaces the words left when every run keeps
    its first period only. Null, empty and blank texts have no words and no
    runs. ``stretch`` first makes the tail of the texts periodic whose
    ``key``'s checksum says so (none with a null key). ``whole=False`` leaves
    out ``runs`` and ``collapsed``. Each row is worked on by itself, so
    repeated rows give equal results; an empty table gives none; other columns
    are not read. The words of one text must fit in a task.
    """
    names = [c for c in RESULT if whole or c not in ("runs", "collapsed")]
    ddl = ", ".join(f"{c} {RESULT[c][1]}" for c in names)
    kept = docs.select(key, text)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            data, ends = text_buffer(batch.column(text))
            raw, at = data.tobytes(), ends.tolist()
            number: defaultdict = defaultdict()
            number.default_factory = number.__len__
            words = [raw[a:b].split() for a, b in zip(at[:-1], at[1:], strict=True)]
            if stretch:
                words = [stretched(w, k) for w, k in zip(words, batch.column(key).to_pylist(), strict=True)]
            runs = runs_of([np.fromiter(map(number.__getitem__, w), np.int64, len(w)) for w in words])
            out: dict[str, list] = {c: [] for c in names}
            for w, r in zip(words, runs, strict=True):
                text_left = b" ".join(collapsed(w, r))
                listed = "".join(f"{s},{n},{p}\n" for s, n, p in r.tolist())
                best = r[np.lexsort((r[:, 2], r[:, 0], -r[:, 1]))[0]].tolist() if len(r) else [None] * 3
                out["n_runs"].append(len(r))
                for name, value in zip(("start", "length", "period"), best, strict=True):
                    out[name].append(value)
                out["exponent_milli"].append(1000 * best[1] // best[2] if len(r) else None)
                out["runs_sha256"].append(hashlib.sha256(listed.encode()).hexdigest())
                out["collapsed_sha256"].append(hashlib.sha256(text_left).hexdigest())
                if whole:
                    out["runs"].append([dict(zip(("start", "length", "period"), x, strict=True)) for x in r.tolist()])
                    out["collapsed"].append(text_left.decode())
            yield pa.RecordBatch.from_arrays([batch.column(key), *(pa.array(out[c], RESULT[c][0]) for c in names)], names=[key, *names])

    return kept.mapInArrow(find, f"{arrow_schema(kept, [key])}, {ddl}")
