"""Importances of a deep tree on all rows, without the tree as a whole."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from truant.operators import models, subtrees
from truant.session import materialize

FEATURES_OF = ["a", "b", "c", "d"]
W = {0.0: 0.5, 1.0: 2.0}  # sums of which are exact, so that ties are ties in any order


@pytest.fixture(scope="module")
def noisy(spark):
    """Four features of few values, so that both learners have the same borders, and a noisy target."""
    rng = np.random.default_rng(11)
    x = rng.integers(0, [2, 40, 100, 7], size=(6_000, 4))
    p = 0.15 + 0.5 * ((x[:, 1] > 20) ^ (x[:, 2] % 10 > 6)) + 0.2 * x[:, 0] * (x[:, 3] > 3)
    y = rng.random(len(x)) < p
    data = [(*map(float, v), int(t)) for v, t in zip(x, y, strict=True)]
    return materialize(spark.createDataFrame(data, "a double, b double, c double, d double, NO_SHOW int"), "noisy")


def test_deep_importances_are_those_of_the_whole_tree(spark, noisy):
    mf = models.learning_frame(noisy, FEATURES_OF, weights=W).persist()
    for depth, least in ((30, 1), (14, 6)):
        tree = models.fit_tree(mf, True, depth, min_rows=least, max_rows=None)
        assert tree.depth > models.TOP_DEPTH
        got = models.tree_importances(mf, FEATURES_OF, W, depth, min_rows=least)
        assert dict(got) == pytest.approx(dict(models.importances(tree, FEATURES_OF)), abs=1e-6)
    mf.unpersist()


def test_importances_do_not_depend_on_where_a_node_is_split(spark, noisy, monkeypatch):
    monkeypatch.setattr(models, "TOP_DEPTH", 2)
    mf = models.learning_frame(noisy, FEATURES_OF, weights=W).persist()
    whole = dict(models.importances(models.fit_tree(mf, True, 12, max_rows=None), FEATURES_OF))
    for local_rows in (10_000, 200):
        assert dict(models.tree_importances(mf, FEATURES_OF, W, 12, local_rows=local_rows)) == pytest.approx(whole, abs=1e-6)
    mf.unpersist()


def test_selections_tree_learns_from_all_rows(spark):
    n = models.MAX_TREE_ROWS + 60_000
    h = [F.pmod(F.xxhash64("id", F.lit(s)), F.lit(m)) for s, m in ((1, 2), (2, 50), (3, 10))]
    rows = spark.range(n).select(F.col("id").alias(models.KEY), h[0].cast("int").alias("a"), h[1].cast("int").alias("b"),
                                 (h[2] + h[0] + (h[1] > 30).cast("int") > 8).cast("int").alias("NO_SHOW"))
    rows = materialize(rows, "many")
    got = models.select_important(rows, rows, ["a", "b"], tree_depth=3)
    w = {float(k): v for k, v in models.class_weights(rows)["class_weight"].items()}
    all_rows = models.tree_estimator(max_depth=3).fit(models.learning_frame(rows, ["a", "b"], weights=w))
    assert dict(got.tree) == pytest.approx(dict(models.importances(all_rows, ["a", "b"])), abs=1e-9)


def walk(values, weights, max_bins):
    """MLlib's loop, as it stands in its findSplits."""
    stride, through, target, out = weights.sum() / max_bins, weights[0], weights.sum() / max_bins, []
    for i in range(1, len(values)):
        before, through = through, through + weights[i]
        if abs(before - target) < abs(through - target):
            out.append(values[i])
            target += stride
    return out


def test_borders_are_mllibs_walk_over_all_values(spark):
    rng = np.random.default_rng(5)
    for heavy in (0, 900, 40_000):
        values = np.sort(rng.normal(size=700))
        weights = rng.integers(1, 30, size=700).astype(float)
        weights[[3, 350]] += heavy
        df = spark.createDataFrame(list(zip(values.tolist(), weights.tolist())), "value double, w double").repartition(5)
        for per_range in (1_000_000, 90):
            got = subtrees._cuts(df, 700, weights.sum() / 64, per_range)
            assert got.tolist() == walk(values, weights, 64)


def test_few_and_many_values_and_rows_that_end_as_leaves(spark):
    rows = spark.range(4_000).select(F.array(F.lit(1.0), F.pmod("id", F.lit(3)).cast("double"), F.col("id").cast("double")).alias("x"),
                                     (F.col("id") >= 2_000).cast("double").alias("label"), F.lit(0.0).alias("leaf"))
    edges = subtrees.borders(rows, 3, np.ones(2), 8)
    assert edges[0].size == 0 and edges[1].tolist() == [1.0, 2.0] and edges[2].tolist() == [500.0 * i for i in range(1, 8)]
    for local_rows in (10_000, 100):
        got = subtrees.importances(rows, 3, {0: (5, [2_000, 2_000])}, [1.0, 1.0], 8, local_rows=local_rows)
        assert got.tolist() == pytest.approx([0, 0, 2_000])  # 4,000 rows of impurity one half, none below
    assert subtrees.importances(rows, 3, {0: (5, [4_000, 0])}, [1.0, 1.0]).tolist() == [0, 0, 0]
    alike = rows.withColumn("x", F.array(F.lit(1.0), F.lit(2.0), F.lit(0.0)))
    assert subtrees.importances(alike, 3, {0: (5, [2_000, 2_000])}, [1.0, 1.0], local_rows=100).tolist() == [0, 0, 0]
