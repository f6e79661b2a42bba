"""The neighbour graph: recall, flat work per vector, and the edges of the input."""

import numpy as np
import pytest

import truant.operators.knn_graph as kg
from truant.operators.smote import smote


def vectors(spark, v, c=None):
    rows = [(f"{i:05d}", x.tolist(), 1 if c is None else int(c[i])) for i, x in enumerate(v)]
    return spark.createDataFrame(rows, "vid string, v array<double>, c long")


def recall(rows, v, k):
    d = np.sqrt(((v[:, None, :] - v[None, :, :]) ** 2).sum(axis=2))
    np.fill_diagonal(d, np.inf)
    kth = np.sort(d, axis=1)[:, k - 1]
    return sum(r.w for r in rows if r.dist <= kth[int(r.q)] + 1e-9) / (k * len(v))


@pytest.mark.parametrize("n", [700, 1400, 2800])
def test_recall_in_twenty_independent_dimensions(spark, n):
    v = np.random.default_rng(n).normal(size=(n, 20))
    assert recall(kg.knn_graph(vectors(spark, v), 5).collect(), v, 5) >= 0.9


def test_work_per_vector_is_flat(spark):
    """Twice and four times the vectors: a round measures about as many pairs for each, and gathers no more than 2 * degree."""
    per_vector = []
    for n in (500, 1000, 2000):
        df = vectors(spark, np.random.default_rng(1).normal(size=(n, 20)))
        start = kg.start_edges(df, n, 12, 1)
        graph = kg._nearest(start.selectExpr("*", "1 as new"), 12)
        per_vector.append((start.count() / n, kg.refine(df, graph, 12, 2).count() / n))
    assert max(p[0] for p in per_vector) <= 12 * kg.TABLES
    assert max(p[1] for p in per_vector) < 24 * 24
    assert per_vector[2][1] < 1.5 * per_vector[0][1]


def test_multiplicities_and_copies(spark):
    """Own copies come first, at distance 0, and a neighbour's copies fill as many slots."""
    v = np.array([[float(i), 0.0] for i in range(40)])
    c = [3 if i == 7 else 1 for i in range(40)]
    got = {}
    for r in kg.knn_graph(vectors(spark, v, c), 3).collect():
        got.setdefault(int(r.q), []).extend([(r.dist, int(r.nb))] * r.w)
    assert sorted(got[7]) == [(0.0, 7), (0.0, 7), (1.0, 6)] and sorted(got[8]) == [(1.0, 7)] * 3
    assert all(len(x) == 3 for x in got.values())


def test_few_vectors(spark):
    assert kg.knn_graph(vectors(spark, np.zeros((0, 2))), 3).count() == 0
    assert kg.knn_graph(vectors(spark, np.array([[1.0, 2.0]])), 3).count() == 0
    pair = kg.knn_graph(vectors(spark, np.array([[0.0, 0.0], [3.0, 4.0]])), 3).collect()
    assert sorted((r.q, r.nb, r.dist) for r in pair) == [("00000", "00001", 5.0), ("00001", "00000", 5.0)]


def test_hot_cell_is_cut(spark, monkeypatch):
    """All vectors in one cell: it is cut by hash, so that no group holds more than about two cells."""
    monkeypatch.setattr(kg, "CELL", 8)
    v = np.repeat(np.arange(4.0), 100)[:, None] * np.array([[1.0, 0.0]]) + np.random.default_rng(0).normal(size=(400, 2)) * 1e-6
    seen = []
    real = kg.near_pairs
    monkeypatch.setattr(kg, "near_pairs", lambda *a: seen.append(len(a[0])) or real(*a))
    assert kg.start_edges(vectors(spark, v), 400, 6, 1).groupBy("q").count().count() == 400


def test_smote_on_the_graph(spark):
    rng = np.random.default_rng(3)
    rows = [(i, *rng.normal(size=3).round(2).tolist(), int(i % 5 == 0)) for i in range(300)] + [(1000 + i, 9.0, 9.0, 9.0, 1) for i in range(3)]
    df = spark.createDataFrame(rows, "APPOINTMENTID long, a double, b double, c double, NO_SHOW int")
    out = smote(df, ["a", "b", "c"], k=3, seed=7, method="graph")
    counts = {(r.NO_SHOW, r.synthetic): r["count"] for r in out.groupBy("NO_SHOW", "synthetic").count().collect()}
    assert counts[(1, 0)] + counts[(1, 1)] == counts[(0, 0)] == 240
    exact = smote(df, ["a", "b", "c"], k=3, seed=7)
    same = lambda d: {(round(r.a, 9), round(r.b, 9), round(r.c, 9)) for r in d.where("synthetic = 1").collect()}
    assert len(same(out) & same(exact)) > 0.95 * len(same(exact))  # this small, the graph knows all neighbours
    with pytest.raises(ValueError):
        smote(df, ["a"], method="other")
