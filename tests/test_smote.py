"""SMOTE: exact neighbour multisets across many buckets, and the invariants."""

import numpy as np
from pyspark.sql import functions as F

from truant.operators.smote import knn_distinct, smote


def _vectors(spark, n=300, seed=1):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        v = rng.integers(0, 6, size=3).astype(float).tolist()  # many exact duplicates
        rows.append((i, v))
    df = spark.createDataFrame(rows, "id long, v array<double>").withColumn("vid", F.md5(F.to_json("v")))
    return rows, df.groupBy("vid").agg(F.first("v").alias("v"), F.count(F.lit(1)).alias("c"))


def test_knn_exact_with_many_leaves(spark):
    k = 5
    rows, distinct = _vectors(spark)
    got = {}
    for r in knn_distinct(distinct, k, rows_per_leaf=8).collect():
        got.setdefault(r.q, []).append((round(r.dist, 9), r.w))
    pts = {r.vid: (np.array(r.v), r.c) for r in distinct.collect()}
    for q, (qv, qc) in pts.items():
        # brute force: multiset of distances of the k nearest rows, self excluded once
        dists = [0.0] * (qc - 1)
        for o, (ov, oc) in pts.items():
            if o != q:
                dists += [float(np.sqrt(((ov - qv) ** 2).sum()))] * oc
        want = sorted(dists)[:k]
        have = sorted(d for d, w in got[q] for _ in range(w))
        assert np.allclose(have, want), (q, have, want)


def test_smote_balances_and_interpolates(spark):
    rng = np.random.default_rng(3)
    rows = [(i, *rng.normal(size=2).round(2).tolist(), int(i % 5 == 0)) for i in range(250)]
    df = spark.createDataFrame(rows, "APPOINTMENTID long, a double, b double, NO_SHOW int")
    out = smote(df, ["a", "b"], k=3, seed=7, rows_per_leaf=8)
    counts = {(r.NO_SHOW, r.synthetic): r["count"] for r in out.groupBy("NO_SHOW", "synthetic").count().collect()}
    assert counts[(1, 0)] + counts[(1, 1)] == counts[(0, 0)] == 200
    mino = np.array([[a, b] for _, a, b, y in rows if y == 1])
    for r in out.where("synthetic = 1").collect():
        s = np.array([r.a, r.b])
        # inside the bounding box of the minority class, and on some segment between two minority rows
        assert (s >= mino.min(0) - 1e-9).all() and (s <= mino.max(0) + 1e-9).all()


def test_hot_vector_salting_keeps_the_result(spark, monkeypatch):
    """A vector holding a third of the minority rows: spreading its draws over
    many salts gives the same synthetic rows as no salting."""
    import truant.operators.smote as sm
    rows = [(i, 1.0, 2.0, 1) for i in range(60)]                      # hot duplicate vector
    rows += [(100 + i, float(i % 7), float(i % 5), 1) for i in range(120)]
    rows += [(1000 + i, float(i % 11), float(i % 13), 0) for i in range(600)]
    df = spark.createDataFrame(rows, "APPOINTMENTID long, a double, b double, NO_SHOW int")

    def run():
        out = smote(df, ["a", "b"], k=5, seed=11, rows_per_leaf=16).where("synthetic = 1")
        return sorted((round(r.a, 9), round(r.b, 9)) for r in out.collect())

    monkeypatch.setattr(sm, "HOT_SHARE", 0)       # nothing is hot: one salt everywhere
    plain = run()
    monkeypatch.setattr(sm, "HOT_SHARE", 10)
    monkeypatch.setattr(sm, "SALT_ROWS", 7)       # the hot vector's ~140 draws over ~20 salts
    salted = run()
    assert len(plain) == 420 and salted == plain


def test_knn_exact_when_leaves_are_shorter_than_k(spark):
    """Leaves of ~3 distinct vectors and k=5: every bound D_k is infinite, so
    every leaf must be visited."""
    k = 5
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=2).round(3).tolist()) for i in range(60)]
    distinct = (spark.createDataFrame(rows, "id long, v array<double>").withColumn("vid", F.md5(F.to_json("v")))
                .groupBy("vid").agg(F.first("v").alias("v"), F.count(F.lit(1)).alias("c")))
    got = {}
    for r in knn_distinct(distinct, k, rows_per_leaf=3).collect():
        got.setdefault(r.q, []).extend([round(r.dist, 9)] * r.w)
    pts = {r.vid: (np.array(r.v), r.c) for r in distinct.collect()}
    for q, (qv, qc) in pts.items():
        dists = [0.0] * (qc - 1)
        for o, (ov, oc) in pts.items():
            if o != q:
                dists += [float(np.sqrt(((ov - qv) ** 2).sum()))] * oc
        assert np.allclose(sorted(got[q]), sorted(dists)[:k]), q


def _distinct(spark, v):
    rows = [(f"{i:05d}", x.tolist(), 1) for i, x in enumerate(v)]
    return spark.createDataFrame(rows, "vid string, v array<double>, c long")


def _visits(spark, v, k=5, rows_per_leaf=50):
    import truant.operators.smote as sm
    df = _distinct(spark, v)
    placed, tree = sm.build_tree(df, len(v), rows_per_leaf)
    d = np.sort(np.sqrt(((v[:, None, :] - v[None, :, :]) ** 2).sum(axis=2)), axis=1)[:, k]
    bound = spark.createDataFrame([(f"{i:05d}", float(x)) for i, x in enumerate(d)], "q string, dk double")
    return sm.leaf_visits(placed, tree, bound).count() / len(v), int((tree.dim[:] >= 0).sum()) + 1


def test_visits_per_vector_stay_flat_in_few_dimensions(spark):
    """With the rows doubled twice, a vector visits about as many leaves in three dimensions,
    and most of them in twenty independent ones (where the exact search is quadratic)."""
    rng = np.random.default_rng(0)
    few = [_visits(spark, rng.normal(size=(n, 3))) for n in (400, 800, 1600)]
    many = [_visits(spark, rng.normal(size=(n, 20))) for n in (400, 800, 1600)]
    assert few[2][0] < 2 * few[0][0] + 1 and few[2][0] < few[2][1] / 3
    assert many[2][0] > 0.5 * (many[2][1] - 1)


def test_groups_of_visits_are_cut(spark, monkeypatch):
    import truant.operators.smote as sm
    monkeypatch.setattr(sm, "VISITS_PER_GROUP", 7)
    monkeypatch.setattr(sm, "BLOCK_CELLS", 50)
    v = np.random.default_rng(2).integers(0, 9, (200, 3)).astype(float)
    v = np.unique(v, axis=0)
    got = {}
    for r in knn_distinct(_distinct(spark, v), 4, rows_per_leaf=10).collect():
        got.setdefault(r.q, []).extend([round(r.dist, 9)] * r.w)
    d = np.sqrt(((v[:, None, :] - v[None, :, :]) ** 2).sum(axis=2))
    assert all(np.allclose(sorted(got[f"{i:05d}"]), np.sort(d[i])[1:5]) for i in range(len(v)))


def test_lsh_recall_in_many_dimensions(spark):
    import truant.operators.smote as sm
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(30, 20)) * 3
    v = centres[rng.integers(0, 30, 600)] + rng.normal(size=(600, 20)) * 0.3
    exact = {(r.q, r.nb) for r in knn_distinct(_distinct(spark, v), 5).collect()}
    near = {(r.q, r.nb) for r in sm.knn_lsh(_distinct(spark, v), 5, radius=4.0, bucket_length=4.0, tables=6).collect()}
    assert len(exact & near) / len(exact) > 0.9
