"""Exact search: against all pairs, with ties, odd vectors, several cells, and vectors that bounds rule out."""

import math

import numpy as np
import pytest

from gridloom.llm import topk as K

SCHEMA = "vec_id long, embedding array<double>, label int, row long, d string"


def brute(rows, every=50, k=5):
    whole = []
    for i, e in rows:
        if i is not None and e is not None and all(x is not None and math.isfinite(x) for x in e):
            whole.append((i, [math.floor(256 * x) for x in e]))
    for a, (i, q) in enumerate(whole):
        if i % every == 0:
            found = [(-sum(x * y for x, y in zip(q, v)), j) for b, (j, v) in enumerate(whole) if a != b and len(v) == len(q)]
            for rank, (s, j) in enumerate(sorted(found)[:k], 1):
                yield i, rank, j, -s


def same(spark, rows, schema=SCHEMA, **options):
    frame = spark.createDataFrame([(i, e, 0, 1, "x") for i, e in rows], schema).repartition(3)
    got = K.top_scores(frame, **options)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == sorted(brute(rows, options.get("every", 50), options.get("k", 5)))


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0]), (50, [1.0, 2.0]), (50, [1.0, 2.0]), (50, [-1.0, 0.001]), (1, [-0.001, 0.0]), (2, [0.0, 0.0]), (3, None), (100, None), (4, [1.0, None]),
        (5, [nan, 1.0]), (6, [inf, 1.0]), (7, []), (150, []), (8, [1.0, 2.0, 3.0]), (200, [1.0, 2.0, 3.0]), (None, [1.0, 2.0]), (9, [1e6, -1e6]),
        (10, [1e-9, -1e-9]), (250, [3.0]),
    ]
    same(spark, rows)
    same(spark, [])
    same(spark, [(50, [1.0])])


def test_large_components(spark):
    same(spark, [(i, [float(10 ** (i % 7)) * (-1) ** i, 1e6, 3.0]) for i in range(0, 120, 2)])
    assert K.scores(np.array([2.0**40, 1.0]), np.array([[2.0**20, 1.0], [2.0**40, 0.0]])).tolist() == [2**60 + 1, 2**63 - 1]


@pytest.mark.parametrize("options", [{}, {"queries": 3, "candidates": 17, "sample": 40}, {"pivots": 2, "k": 1}, {"sample": 1}])
def test_all_pairs_in_cells(spark, options):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(6, 8)) * 3
    rows = [(i, (centres[i % 6] + rng.normal(size=8) * 0.1).tolist()) for i in range(600)]
    rows += [(600 + i, rows[50][1]) for i in range(150)]
    same(spark, rows, **options)


def test_bounds_rule_out_and_stop_exactly():
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(20, 16)) * 1000
    v = np.floor(centres[np.arange(8000) % 20] + rng.normal(size=(8000, 16)) * 5)
    greatest = float((v * v).sum(axis=1).max())
    table = K.Pivots(v[:200], greatest, 32)
    bound = K.bounds(table.distances(v[:10], query=True), table.distances(v), 1.0)
    for i in range(10):
        exact = np.sqrt((v[i] @ v[i]) + greatest - 2 * (v @ v[i]))
        assert (bound[i] <= exact).all()
        at, best, looked = K.search(v[i], None, bound[i], v, np.arange(8000), i, float(v[i] @ v[i]) + greatest, 5)
        s = (v @ v[i]).astype(np.int64)
        want = [j for j in np.lexsort((np.arange(8000), -s)) if j != i][:5]
        assert at.tolist() == want and best.tolist() == s[want].tolist() and looked < 8000


def test_sample_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    got = sorted(map(tuple, K.top_scores(table).collect()))
    assert got == sorted(brute([(r.vec_id, r.embedding) for r in table.collect()]))
