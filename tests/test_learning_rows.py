import threading

import numpy as np
import pytest
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder

from truant.operators import models
from truant.session import materialize, spread


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(24_000, 3))
    y = (x[:, 0] + x[:, 1] * x[:, 2] + rng.normal(size=len(x)) > 0.8).astype(int)
    data = [(i, i % 3, *map(float, v), int(t)) for i, (v, t) in enumerate(zip(x, y, strict=True))]
    return materialize(spark.createDataFrame(data, "id long, fold int, a double, b double, c double, NO_SHOW int").coalesce(1), "learning-test")


def sizes(df):
    return df.rdd.mapPartitions(lambda p: [sum(1 for _ in p)]).collect()


def test_learners_rows_use_every_core_and_bounded_tasks(spark, rows):
    cores = spark.sparkContext.defaultParallelism
    assert rows.rdd.getNumPartitions() == 1  # a small file is one task
    mf = models.learning_frame(rows, ["a", "b", "c"], "NO_SHOW", {0.0: 1.0, 1.0: 2.0}, keep=["fold"])
    n = sizes(mf)
    assert len(n) == cores and sum(n) == 24_000 and max(n) <= 24_000 / cores * 1.1
    assert mf.columns == ["fold", "label", "weight", "features"]
    n = sizes(spread(rows, 24_000, rows_per_task=1_000, least=500))
    assert len(n) % cores == 0 and sum(n) == 24_000 and max(n) <= 1_100
    assert len(sizes(spread(rows.limit(10), 10))) == 1


class Counted:
    """An estimator that counts its fits."""

    def __init__(self, estimator):
        self.estimator, self.fits = estimator, 0

    def fit(self, df, params):
        self.fits += 1
        return self.estimator.fit(df, params)


def test_cross_validation_scores_as_mllibs_without_a_fit_that_nobody_asks_for(spark, rows):
    mf = models.learning_frame(rows, ["a", "b", "c"], "NO_SHOW", keep=["fold"]).persist()
    est = models.gbt_estimator({"n_estimators": 2, "max_depth": 2}, weighted=False)
    maps = ParamGridBuilder().addGrid(est.maxDepth, [1, 4]).build()
    counted = Counted(est)
    got = models.cross_validate(counted, mf, maps, k=3)
    assert counted.fits == 6
    theirs = CrossValidator(estimator=est, estimatorParamMaps=maps, evaluator=models.auc_evaluator(), numFolds=3, foldCol="fold").fit(mf)
    assert got.avgMetrics == pytest.approx(theirs.avgMetrics, abs=0.005)
    assert got.bestModel.getMaxDepth() == maps[int(np.argmax(got.avgMetrics))][est.maxDepth] and counted.fits == 7
    mf.unpersist()


def test_boosting_keeps_node_ids_only_for_deep_trees_and_grows_the_same_trees(spark, rows):
    mf = models.learning_frame(rows, ["a", "b", "c"], "NO_SHOW", {0.0: 1.0, 1.0: 2.0})
    shallow, deep = models.gbt_estimator({"n_estimators": 3, "max_depth": 4}), models.gbt_estimator(models.REPORTED_GBT_PARAMS)
    assert not shallow.getCacheNodeIds() and deep.getCacheNodeIds()
    maps = models.gbt_param_maps([{"max_depth": 3}, {"max_depth": 14}], models.gbt_estimator())
    assert [v for m in maps for p, v in m.items() if p.name == "cacheNodeIds"] == [False, True]
    assert shallow.fit(mf).toDebugString.split("\n")[1:] == shallow.copy().setCacheNodeIds(True).fit(mf).toDebugString.split("\n")[1:]


def test_selection_fits_both_learners_at_the_same_time_and_keeps_what_each_finds(spark, rows, monkeypatch):
    features, together = ["a", "b", "c"], threading.Barrier(2, timeout=60)
    w = {float(k): v for k, v in models.class_weights(rows)["class_weight"].items()}
    mf = models.learning_frame(rows, features, weights=w)
    coef = dict(models.coefficients(models.fit_logistic(mf), features))
    imp = dict(models.importances(models.fit_tree(mf, max_depth=3), features))

    def meeting(fit):
        def run(*args, **kw):
            together.wait()
            return fit(*args, **kw)
        return run

    for name in ("fit_logistic", "fit_tree"):
        monkeypatch.setattr(models, name, meeting(getattr(models, name)))
    keyed = rows.withColumnRenamed("id", models.KEY)
    got = models.select_important(keyed, keyed, features, tree_depth=3)
    assert dict(got.logistic) == pytest.approx(coef, abs=1e-3) and dict(got.tree) == pytest.approx(imp, abs=0.01)
    assert got.features == sorted(f for f in features if abs(coef[f]) >= 0.01 or imp[f] >= 0.01)


def test_trees_and_forests_keep_node_ids_only_for_deep_trees_and_grow_the_same_trees(spark, rows):
    mf = models.learning_frame(rows, ["a", "b", "c"], "NO_SHOW", {0.0: 1.0, 1.0: 2.0})
    assert models.tree_estimator().getCacheNodeIds() and models.forest_estimator().getCacheNodeIds()
    for shallow in (models.tree_estimator(max_depth=5), models.forest_estimator(num_trees=3, max_depth=5)):
        assert not shallow.getCacheNodeIds()
        assert shallow.fit(mf).toDebugString.split("\n")[1:] == shallow.copy().setCacheNodeIds(True).fit(mf).toDebugString.split("\n")[1:]


def counting(df, counter):
    """``df``, whose rows are counted whenever they are made."""
    def run(batches):
        for b in batches:
            counter.add(b.num_rows)
            yield b
    return df.mapInArrow(run, df.schema)


def test_boosting_makes_its_rows_once_and_leaves_a_kept_frame_kept(spark, rows):
    made = spark.sparkContext.accumulator(0)
    mf = models.model_frame(counting(rows.drop("id", "fold"), made), ["a", "b", "c"])
    models.fit_gbt(mf, {"n_estimators": 2, "max_depth": 2}, weighted=False)
    assert made.value == 24_000 and not mf.is_cached
    kept = mf.persist()
    models.fit_gbt(kept, {"n_estimators": 2, "max_depth": 2}, weighted=False)
    assert kept.storageLevel.useMemory
    kept.unpersist()
