import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from chondria.llm import topk

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, k=20, step=20, scale=64):
    """[(query, rank, id, score)] by all scores of all pairs, in whole numbers."""
    whole = [(i, [max(-2 ** 63, min(2 ** 63 - 1, math.floor(scale * x))) for x in v]) for i, v in rows
             if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for place, (i, q) in enumerate(whole):
        if i is None or i % step:
            continue
        scores = [(sum(a * b for a, b in zip(q, v)), j) for other, (j, v) in enumerate(whole) if other != place]
        scores.sort(key=lambda s: (-s[0], s[1] is None, s[1]))
        out += [(i, r + 1, j, s) for r, (s, j) in enumerate(scores[:k])]
    return sorted(out, key=repr)


def found(spark, rows, parts=3, **more):
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).repartition(parts).withColumn("cell", F.lit(1)).withColumn("rank", F.lit("x"))
    return sorted((tuple(r) for r in topk.top_k(df, F.col("vec_id") % more.get("step", 20) == 0, k=more.get("k", 20)).collect()), key=repr)


@pytest.fixture
def small(monkeypatch):
    """Several blocks, groups and rounds of queries on small tables."""
    for name, value in (("BLOCK", 40), ("GROUP_BYTES", 2000), ("QUERY_BYTES", 300), ("TOGETHER", 4), ("STEP", 3)):
        monkeypatch.setattr(topk, name, value)


@pytest.mark.parametrize("seed", range(3))
def test_the_best_of_all_pairs(spark, docs, small, seed):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(5, 10))
    rows = [(i, (middle[rng.integers(5)] * 10 ** (seed - 1) + rng.normal(size=10) / 8).tolist()) for i in range(400)]
    assert found(spark, rows) == brute(rows)


def test_ties_go_by_the_smaller_id(spark, docs, small):
    rows = [(i, [1.0, 0.5 * (i % 3)]) for i in range(300)]
    assert found(spark, rows) == brute(rows)


def test_odd_vectors(spark, docs, small):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (20, []), (40, None), (60, [nan, 1.0]), (80, [1.0, None]), (100, [inf]), (120, [1.0]), (None, [3.0, 3.0]),
            (None, None), (3, [-0.001, 0.0, 9.0]), (140, [0.5] * 5000), (5, [0.25] * 5000)]
    assert found(spark, rows, k=3) == brute(rows, k=3)
    assert found(spark, rows, k=20) == brute(rows, k=20)
    assert found(spark, []) == []
    assert found(spark, [(1, [1.0])]) == []
    assert found(spark, [(0, [1.0])]) == []


def test_scores_are_exact_at_any_size(spark, docs, small):
    rng = np.random.default_rng(9)
    rows = [(i, (rng.integers(-2 ** 40, 2 ** 40, 6) / 64 / 2 ** 12).tolist()) for i in range(100)]      # products of 56 bits
    assert found(spark, rows, k=5) == brute(rows, k=5)
    got = found(spark, [(0, [1e300, 1.0]), (1, [1e300, 1.0]), (2, [-1e300, 1.0])], k=5)
    assert got == [(0, 1, 1, 2 ** 63 - 1), (0, 2, 2, -2 ** 63)]


def test_bounds_leave_out_most(small):
    """A query near one of many far groups needs few whole scores."""
    rng = np.random.default_rng(1)
    v = rng.integers(-3, 4, (32, 2000))
    v[0] = np.where(np.arange(2000) < 50, 100, -100)
    left, scores = topk.survivors(np.full((1, 32), 1) * v[:, :1].T, v, np.array([9000.0]))
    assert set(np.flatnonzero(v[:, 0] @ v >= 9000)) <= set(left.tolist()) and len(left) <= 60
    assert (scores[0] == v[:, 0] @ v[:, left]).all()
