import math
import random

import pytest
from pyspark.sql import functions as F

from larkspur.llm import knn
from tests.llm.frames import table

SCHEMA = "vec_id long, embedding array<double>"


def expected(rows, k, is_query):
    kept = []
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(64 * x) for x in v]))
    out = [(q, [(-sum(a * b for a, b in zip(u, v)), i) for i, v in kept if i != q]) for q, u in kept if is_query(q)]
    return sorted((q, rank, i, -s) for q, c in out for rank, (s, i) in enumerate(sorted(c)[:k], 1))


def found(spark, rows, k=20, pivots=knn.PIVOTS):
    got = knn.top_k(table(spark, SCHEMA, rows), F.col("vec_id") % 5 == 0, k, pivots=pivots)
    return sorted(map(tuple, got.collect()))


@pytest.mark.parametrize("kind,pivots", [("sphere", 16), ("clusters", 6), ("few", 3), ("far", 16)])
def test_against_brute_force(spark, monkeypatch, kind, pivots):
    monkeypatch.setattr(knn, "BLOCK", 7)
    rng = random.Random(kind)
    centres = [[rng.gauss(0, 1) for _ in range(5)] for _ in range(6)]

    def vector():
        if kind == "sphere":
            return [rng.gauss(0, 1) for _ in range(5)]
        if kind == "clusters":
            return [x * 10 + rng.gauss(0, 0.01) for x in rng.choice(centres)]
        if kind == "few":
            return list(rng.choice(centres[:2]))
        return [rng.gauss(0, 1) * 10 ** rng.randint(-3, 5) for _ in range(5)]
    rows = [(i, vector()) for i in range(150)] + [(7, vector()), (200, [0.0] * 5), (5, vector())]
    assert found(spark, rows, 6, pivots) == expected(rows, 6, lambda i: i % 5 == 0)


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (5, None), (10, [None, 1.0]), (15, [nan, 0.0]), (20, [inf, 0.0]), (25, []), (1, [1.0]), (2, [0.5, 0.5, 9.0]), (None, [1.0, 1.0]), (30, [1.0, 2.0]), (30, [1.0, 2.0])]
    want = expected([(i, None if v is None else v + [0.0] * (3 - len(v)) if i not in (10, 15, 20) else v) for i, v in rows], 20, lambda i: i % 5 == 0)
    assert found(spark, rows) == want
    assert found(spark, []) == [] and found(spark, [(5, [1.0])]) == [] and found(spark, [(5, None)]) == []


def test_large_values_stay_exact(spark):
    rows = [(i, [float(2 ** 24 + i), float(-(2 ** 23) - 3 * i)]) for i in range(11)]
    assert found(spark, rows, 3) == expected(rows, 3, lambda i: i % 5 == 0)


def test_far_cells_are_not_sent(spark):
    rows = [(i, [100.0 * (i % 2) + 0.01 * i, 100.0 - 100.0 * (i % 2)]) for i in range(400)]
    got = knn.top_k(table(spark, SCHEMA, rows), F.col("vec_id") % 5 == 0, 3, pivots=8)
    assert sorted(map(tuple, got.collect())) == expected(rows, 3, lambda i: i % 5 == 0)


def test_repeated_ids_hide_no_neighbours(spark):
    """Rows of the query's own id fill the cells around it; its neighbours lie in far ones."""
    rng = random.Random(2)
    rows = [(5, [100.0 + rng.random(), rng.random()]) for _ in range(60)] + [(5, [100.0, 0.5])] * 5
    rows += [(10 + i, [rng.random(), 100.0 * (i % 2) + rng.random()]) for i in range(80)]
    assert found(spark, rows, 4, 8) == expected(rows, 4, lambda i: i % 5 == 0)
