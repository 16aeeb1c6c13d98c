import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import vector_search as vs


def plain(rows, k=10):
    """All pairs, with whole numbers."""
    good = {(i, tuple(math.floor(1024 * float(np.float32(x))) for x in v)) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for q, a in good:
        if q % 100 == 0:
            near = sorted((-max(min(sum(x * y for x, y in zip(a, b)), 2**63 - 1), -2**63), i) for i, b in good if i != q and len(a) == len(b))[:k]
            out += [(q, n, i, -s) for n, (s, i) in enumerate(near, 1)]
    return sorted(out)


def search(spark, rows, slots=3):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS slot", "2 AS dim", "3 AS v", "4 AS ids")
    return sorted(tuple(r) for r in vs.top_k(frame, "vec_id", "embedding", F.col("vec_id") % 100 == 0, slots=slots).collect())


def test_against_all_pairs(spark, monkeypatch):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(0, 0.2, 16)]) for i in range(900)]
    monkeypatch.setattr(vs, "BLOCK", 64)
    monkeypatch.setattr(vs, "STEP", 4)
    assert search(spark, rows) == plain(rows)


def test_ties_and_odd_rows(spark):
    same = [0.25, -0.5]
    rows = [(i, same) for i in range(0, 130)] + [
        (200, None), (201, [0.1, None]), (202, [0.1, float("nan")]), (203, [float("inf"), 0.0]), (None, same),
        (300, [0.0, 0.0]), (301, [0.1]), (400, [0.5]), (400, [0.5]), (500, []), (501, []), (600, [3e38, 3e38]), (601, [-3e38, 1.0]),
        (5, same), (6, [0.26, -0.5])]
    assert search(spark, rows) == plain(rows)


def test_few_and_none(spark):
    assert search(spark, [(100, [1.0])]) == []
    assert search(spark, [(100, [1.0]), (7, [2.0])]) == [(100, 1, 7, 2048 * 1024)]
    assert search(spark, []) == []


@pytest.mark.parametrize("seed", range(5))
def test_bounds_hold(seed):
    rng = np.random.default_rng(seed)
    matrix = np.floor(rng.normal(0, 10.0 ** rng.integers(0, 6), (200, 8)))
    matrix[:, 2] = 7  # a component without spread
    queries = np.floor(rng.normal(0, 300, (20, 8)))
    lower, upper = vs.bounds(queries, *vs.approximate(matrix))
    exact = queries @ matrix.T
    assert (lower <= exact).all() and (exact <= upper).all()
