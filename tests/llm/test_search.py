"""Nearest neighbours against brute force."""

import numpy as np
from pyspark.sql import functions as F

from cadence.llm import ann, queries
from tests.conftest import SF_SMALL

VECTORS = "vec_id bigint, embedding array<float>, label int"


def brute(ids, x, k, every):
    out = {}
    for q in ids[ids % every == 0]:
        score = x @ x[np.flatnonzero(ids == q)[0]]
        order = [i for i in np.lexsort((ids, -score)) if ids[i] != q][:k]
        out[int(q)] = [(int(ids[i]), float(score[i])) for i in order]
    return out


def results(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def recall(got, want):
    return sum(len({v for v, _ in got.get(q, [])} & {v for v, _ in w}) for q, w in want.items()) / sum(len(w) for w in want.values())


def test_op2_recall_and_scores(spark):
    rows = queries.table(spark, SF_SMALL, "embeddings").toPandas()
    ids, x = rows.vec_id.to_numpy(), np.stack(rows.embedding).astype(np.float64)
    got, want = results(queries.op2_hilbert_curves(spark, SF_SMALL)), brute(ids, x, 20, 20)
    assert got.keys() == want.keys() and recall(got, want) >= 0.9
    at = {int(i): v for i, v in zip(ids, x)}
    assert all(abs(s - at[q] @ at[v]) < 1e-12 for q, w in got.items() for v, s in w)


def test_clustered_vectors_in_narrow_windows(spark):
    """With clusters the fitted window is a small part of all rows, and recall holds."""
    rng = np.random.default_rng(5)
    middle = rng.normal(size=(60, 16))
    x = (middle[rng.integers(0, 60, 12_000)] + 0.05 * rng.normal(size=(12_000, 16))).astype(np.float32)
    rows = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], VECTORS)
    got, want = results(ann.search(rows, F.col("vec_id") % 400 == 0, k=10)), brute(np.arange(12_000), x.astype(np.float64), 10, 400)
    assert recall(got, want) >= 0.9


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [None, 1.0]),
            (9, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (10, [0.0, 1.0]), (20, [0.5, 0.5])]
    docs = spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS).withColumns({c: F.lit("clash") for c in ("score", "rank", "curve", "at", "key")})
    got = results(ann.search(docs, F.col("vec_id") % 20 == 0, k=20))
    assert {q: [v for v, _ in w] for q, w in got.items()} == {0: [1, 2, 20, 10], 20: [0, 1, 2, 10]}
    # Different vectors of one number, some equal to those of other numbers: the nearest counts.
    twice = spark.createDataFrame([(0, [1.0, 0.0], 0), (0, [0.0, 1.0], 0), (1, [0.0, 1.0], 0), (1, [1.0, 0.0], 0), (2, [0.0, 2.0], 0), (3, [0.5, 0.0], 0)], VECTORS)
    assert results(ann.search(twice, F.col("vec_id") == 0, k=20)) == {0: [(2, 2.0), (1, 1.0), (3, 0.5)]}
    assert ann.search(spark.createDataFrame([], VECTORS), F.col("vec_id") % 20 == 0).count() == 0
    assert ann.search(spark.createDataFrame([(0, [1.0], 0)], VECTORS), F.col("vec_id") % 20 == 0).count() == 0


def test_runs_of_equal_vectors_longer_than_the_window(spark):
    """Ties go to the smallest numbers, as by brute force, in runs of 1,200 and of 3 equal vectors."""
    rng = np.random.default_rng(11)
    middle = rng.normal(size=(40, 8))
    x = (middle[rng.integers(0, 40, 6000)] + 0.05 * rng.normal(size=(6000, 8))).astype(np.float32)
    hot = rng.permutation(6000)[:1800]
    x[hot[:1200]] = x[hot[0]] * 3
    x[hot[1200:]] = x[hot[1200:]][np.arange(600) // 3 * 3]
    rows = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], VECTORS)
    got, want = results(ann.search(rows, F.col("vec_id") % 50 == 0, k=10)), brute(np.arange(6000), x.astype(np.float64), 10, 50)
    assert recall(got, want) >= 0.9
    equal = [q for q in want if q in set(hot[:1200].tolist())]
    assert len(equal) > 10 and all([v for v, _ in got[q]] == [v for v, _ in want[q]] for q in equal)


def test_hilbert_curve_visits_neighbours():
    """All cells of a grid get different keys, and cells next in order are next to each other."""
    for dimensions, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dimensions, indexing="ij"), -1).reshape(-1, dimensions)
        keys = ann.hilbert_keys(cells, bits)
        order = np.argsort(keys)
        assert sorted(keys.tolist()) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[order], axis=0)).sum(1) == 1).all()
