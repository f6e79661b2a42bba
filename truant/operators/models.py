"""Model fitting with Spark MLlib (distributed learners; no single-node fit).

Mapping of the original learners:

* balanced logistic regression (C = 1 on the summed loss) ->
  ``LogisticRegression(weightCol, regParam = 1 / sum(w), elasticNetParam=0,
  standardization=False)``; balanced weights sum to n, so 1/sum(w) = 1/n.
* balanced decision tree (unlimited depth) -> ``DecisionTreeClassifier``
  with ``maxDepth`` 30 (MLlib's limit) and more bins than the default 32.  A
  tree whose leaves hold single rows grows with the data and lives on the
  driver, so ``select_important``, which asks for its importances alone, has
  MLlib fit its top on all rows and the rest grown in the tasks
  (:mod:`truant.operators.subtrees`); ``min_rows`` per leaf is a parameter.
* random forest (100 trees, unlimited depth) -> ``RandomForestClassifier``,
  ``maxDepth`` 30.
* gradient boosting with ``scale_pos_weight`` -> ``GBTClassifier`` with a
  weight column (positives weighted n_neg / n_pos); trees / depth / rate /
  row share map directly, column share per tree maps to the per-node
  ``featureSubsetStrategy``.  Two have no equivalent and are mapped by
  convention: ``min_child_weight`` (a sum of second derivatives) becomes the
  least number of rows of a node, and ``gamma`` (a loss reduction summed over a
  node) GAMMA_TO_INFO_GAIN times itself as the least information gain a row.

Defaults are the original's settings; a caller that wants a cheaper fit says so.
"""

from __future__ import annotations

import random
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property
from multiprocessing.pool import ThreadPool

import pyarrow as pa
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LogisticRegression,
                                       RandomForestClassifier)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from truant.operators import encode, evaluate, sampling, subtrees
from truant.operators.smote import smote
from truant.plans.prefix import running_totals
from truant.schema import KEY, TARGET
from truant.session import local_frame, materialize, side_by_side, spread

LABEL, FEATURES, WEIGHT = "label", "features", "weight"

# The defaults of the original's boosting library, the tuned
# parameters reported for its model, and the search space and number of
# evaluations of its tuner.
DEFAULT_GBT_PARAMS = {"n_estimators": 100, "max_depth": 6, "learning_rate": 0.3, "gamma": 0.0,
                      "colsample_bytree": 1.0, "subsample": 1.0, "min_child_weight": 1}
REPORTED_GBT_PARAMS = {"n_estimators": 344, "max_depth": 11, "learning_rate": 0.01024, "gamma": 0.4565,
                       "colsample_bytree": 0.5547, "subsample": 0.8528, "min_child_weight": 5}
SEARCH_SPACE = {"n_estimators": (50, 1000, "int"), "max_depth": (3, 14, "int"),
                "learning_rate": (0.01, 0.2, "float"), "gamma": (0.0, 0.5, "float"),
                "colsample_bytree": (0.3, 1.0, "float"), "subsample": (0.6, 1.0, "float"),
                "min_child_weight": (1, 10, "int")}
MAX_EVALS = 100
FOLDS = 5

GAMMA_TO_INFO_GAIN = 0.01
MAX_TREE_ROWS = 1_000_000
#: Rows of the fits that cross-validation runs at the same time.
MAX_ROWS_AT_ONCE = 10_000_000
#: Rows walk down trees of this depth at most from their root in every pass.  Deeper ones, which a task
#: would get whole, keep a node id a row instead, a new array for each row in each pass.
MAX_DEPTH_WALKED = 10
#: Levels of a deep tree that MLlib fits, see tree_importances.
TOP_DEPTH = 10
TREE_SEED = 42


def model_frame(df: DataFrame, features: list[str], target: str = TARGET,
                weights: dict | None = None, keep: list[str] | None = None) -> DataFrame:
    """Assemble ``features`` into a vector, ``label`` as double, optional
    class weights; nulls in features become 0 (never dropped)."""
    cols = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in features]
    base = df.select(*(keep or []), *cols,
                     *([F.col(target).cast("double").alias(LABEL)] if target in df.columns else []))
    if weights is not None and target in df.columns:
        base = encode.with_weights(base, weights, LABEL, WEIGHT)
    return VectorAssembler(inputCols=features, outputCol=FEATURES).transform(base)


def learning_frame(df: DataFrame, features: list[str], target: str = TARGET, weights: dict | None = None,
                   keep: list[str] | None = None) -> DataFrame:
    """What a learner reads of :func:`model_frame`, its vector, label and weight, after the columns ``keep``;
    evenly dealt to tasks, as learners pass over their rows hundreds of times.  ``df`` should be a written table."""
    narrow = spread(df.select(*(keep or []), *features, target), df.count())
    return model_frame(narrow, features, target, weights, keep).drop(*features)


def class_weights(df: DataFrame, target: str = TARGET) -> dict:
    return encode.balanced_weights(df, target)


def pos_weights(df: DataFrame, target: str = TARGET, override: float | None = None) -> dict:
    """{0: 1, 1: n_neg / n_pos}: the boosted model's positive-class weight,
    computed from the data unless given."""
    w = encode.balanced_weights(df, target)
    spw = override if override is not None else w["scale_pos_weight"]
    return {0.0: 1.0, 1.0: float(spw)}


def logistic_estimator(n: int, weighted: bool = True) -> LogisticRegression:
    lr = LogisticRegression(featuresCol=FEATURES, labelCol=LABEL, maxIter=200, regParam=1.0 / max(n, 1),
                            elasticNetParam=0.0, standardization=False, tol=1e-8)
    return lr.setWeightCol(WEIGHT) if weighted else lr


def fit_logistic(mf: DataFrame, weighted: bool = True, n: int | None = None):
    return logistic_estimator(n or mf.count(), weighted).fit(mf)


def tree_estimator(weighted: bool = True, max_depth: int = 30, max_bins: int = 128, min_rows: int = 1, seed: int = 42):
    dt = DecisionTreeClassifier(featuresCol=FEATURES, labelCol=LABEL, maxDepth=max_depth, maxBins=max_bins,
                                minInstancesPerNode=min_rows, seed=seed, checkpointInterval=10, cacheNodeIds=max_depth > MAX_DEPTH_WALKED)
    return dt.setWeightCol(WEIGHT) if weighted else dt


def fit_tree(mf: DataFrame, weighted: bool = True, max_depth: int = 30, max_bins: int = 128, min_rows: int = 1, seed: int = 42,
             max_rows: int | None = MAX_TREE_ROWS):
    """A single tree, which is held on the driver: it learns from about ``max_rows`` rows at most, a sample of larger frames (None: from all)."""
    n = 0 if max_rows is None else mf.count()
    if max_rows is not None and n > max_rows:
        mf = mf.sample(max_rows / n, seed=seed)
    return tree_estimator(weighted, max_depth, max_bins, min_rows, seed).fit(mf)


def forest_estimator(weighted: bool = True, num_trees: int = 100, max_depth: int = 30, min_rows: int = 1, seed: int = 42):
    rf = RandomForestClassifier(featuresCol=FEATURES, labelCol=LABEL, numTrees=num_trees, maxDepth=max_depth,
                                minInstancesPerNode=min_rows, seed=seed, maxBins=64, checkpointInterval=10, cacheNodeIds=max_depth > MAX_DEPTH_WALKED)
    return rf.setWeightCol(WEIGHT) if weighted else rf


def fit_forest(mf: DataFrame, weighted: bool = True, num_trees: int = 100, max_depth: int = 30, min_rows: int = 1, seed: int = 42):
    return forest_estimator(weighted, num_trees, max_depth, min_rows, seed).fit(mf)


def gbt_estimator(params: dict | None = None, weighted: bool = True, seed: int = 42) -> GBTClassifier:
    """GBTClassifier from boosting parameters named as in the original tuner."""
    p = {**DEFAULT_GBT_PARAMS, **(params or {})}
    subset = "all" if p["colsample_bytree"] >= 1.0 else str(round(float(p["colsample_bytree"]), 4))
    gbt = GBTClassifier(featuresCol=FEATURES, labelCol=LABEL, maxIter=int(p["n_estimators"]),
                        maxDepth=int(p["max_depth"]), stepSize=float(p["learning_rate"]),
                        minInfoGain=float(p["gamma"]) * GAMMA_TO_INFO_GAIN, subsamplingRate=float(p["subsample"]),
                        featureSubsetStrategy=subset, minInstancesPerNode=max(1, int(p["min_child_weight"])),
                        seed=seed, maxBins=64, checkpointInterval=10, cacheNodeIds=int(p["max_depth"]) > MAX_DEPTH_WALKED)
    if weighted:
        gbt.setWeightCol(WEIGHT)
    return gbt


def fit_gbt(mf: DataFrame, params: dict | None = None, weighted: bool = True, seed: int = 42):
    """``mf``, unless it is kept, is on disk meanwhile: the learner asks for it several times, and each time its rows would be dealt anew."""
    estimator = gbt_estimator(params, weighted, seed)
    if mf.storageLevel != StorageLevel.NONE:
        return estimator.fit(mf)
    mf = mf.persist(StorageLevel.DISK_ONLY)
    try:
        return estimator.fit(mf)
    finally:
        mf.unpersist()


def coefficients(model, features: list[str]) -> list[tuple[str, float]]:
    return list(zip(features, [float(x) for x in model.coefficients.toArray()], strict=True))


def importances(model, features: list[str]) -> list[tuple[str, float]]:
    imp = model.featureImportances.toArray()
    return sorted(zip(features, [float(x) for x in imp], strict=True), key=lambda t: -t[1])


# Frames of (name, value), one row a feature.
def importance_frame(spark, pairs: list[tuple[str, float]], value: str = "Importance") -> DataFrame:
    return local_frame(spark, pairs, **{"Feature": pa.string(), value: pa.float64()})


def sort_importance(imp: DataFrame, value: str = "Importance", name: str = "Feature") -> DataFrame:
    """Rows with their rank by descending value (ties by name).

    The rank is the number of rows that sort before, from counts of equal
    values, so the frame may be of any size."""
    n = imp.count()
    by_value = imp.groupBy(F.col(value).alias("__v")).agg(F.count(F.lit(1)).alias("__n"))
    above = running_totals(by_value, "__v", ["__n"], n, descending=True).select("__v", (F.col("cum___n") - F.col("__n")).alias("__above"))
    nth = F.row_number().over(Window.partitionBy(value).orderBy(name))
    ranked = imp.withColumn("__nth", nth).join(above, imp[value].eqNullSafe(F.col("__v")))
    return ranked.select(*imp.columns, (F.col("__above") + F.col("__nth")).alias("rank"))


def threshold_features(imp: DataFrame, threshold: float = 0.01, value: str = "Importance", absolute: bool = True) -> DataFrame:
    """Rows whose value (or its absolute value) reaches the threshold."""
    v = F.abs(F.col(value)) if absolute else F.col(value)
    return imp.where(v >= threshold)


def union_features(*frames: DataFrame, name: str = "Feature") -> DataFrame:
    """The names in any of the frames, once each."""
    out = frames[0].select(name)
    for f in frames[1:]:
        out = out.union(f.select(name))
    return out.distinct()


@dataclass
class Selection:
    features: list[str]
    logistic: list[tuple[str, float]]
    tree: list[tuple[str, float]]


def tree_importances(mf: DataFrame, features: list[str], weights: dict, max_depth: int = 30, max_bins: int = 128, min_rows: int = 1,
                     local_rows: int = subtrees.LOCAL_ROWS) -> list[tuple[str, float]]:
    """Importances of one tree on all rows of ``mf``, of any number: its first TOP_DEPTH levels are
    :func:`fit_tree`'s, and what grows below their leaves is never held as a whole.

    Importances are sums over a tree's nodes.  Those of the top lower the impurity from
    that of all rows to that of the leaves, which MLlib's shares are multiplied with."""
    top = fit_tree(mf, True, min(max_depth, TOP_DEPTH), max_bins, min_rows, max_rows=None)
    if max_depth <= TOP_DEPTH:
        return importances(top, features)
    w = [weights.get(float(c), 0.0) for c in range(top.numClasses)]
    depths = subtrees.leaf_depths(top.toDebugString)
    rows = top.setLeafCol("leaf").transform(mf).select("leaf", vector_to_array(FEATURES).alias("x"), LABEL)
    counts = [[0] * len(w) for _ in depths]
    for r in rows.groupBy("leaf", LABEL).count().collect():
        counts[int(r["leaf"])][int(r[LABEL])] = r["count"]
    gained = subtrees.impurity_of([[sum(c) for c in zip(*counts, strict=True)]], w) - subtrees.impurity_of(counts, w)
    below = subtrees.importances(rows, len(features), {i: (max_depth - d, counts[i]) for i, d in enumerate(depths)}, w, max_bins, min_rows, local_rows)
    imp = top.featureImportances.toArray() * gained + below
    imp = imp / imp.sum() if imp.sum() > 0 else imp
    return sorted(zip(features, [float(x) for x in imp], strict=True), key=lambda t: -t[1])


def select_important(train_scaled: DataFrame | Callable[[], DataFrame], train_raw: DataFrame, features: list[str],
                     target: str = TARGET, threshold: float = 0.01,
                     tree_depth: int = 30, tree_min_rows: int = 1) -> Selection:
    """Union of |logistic coefficient| >= t (scaled frame, or what makes it) and
    tree importance >= t (unscaled frame), both with balanced class weights and
    on all rows.  Both are fitted at the same time."""
    spark = train_raw.sparkSession
    w = class_weights(train_raw, target)["class_weight"]
    w = {float(k): v for k, v in w.items()}

    def logistic() -> list[tuple[str, float]]:
        # on disk, as the learner keeps its own blocks of them in memory
        rows = train_scaled() if callable(train_scaled) else train_scaled
        mf = learning_frame(rows, features, target, w).persist(StorageLevel.DISK_ONLY)
        try:
            return coefficients(fit_logistic(mf, True, train_raw.count()), features)
        finally:
            mf.unpersist()

    def tree() -> list[tuple[str, float]]:
        mf = learning_frame(train_raw, features, target, w).persist(StorageLevel.DISK_ONLY)
        try:
            return tree_importances(mf, features, w, tree_depth, min_rows=tree_min_rows)
        finally:
            mf.unpersist()

    coef, imp = side_by_side(spark, logistic, tree)
    kept = union_features(threshold_features(importance_frame(spark, coef), threshold),
                          threshold_features(importance_frame(spark, imp), threshold, absolute=False))
    return Selection(sorted(r[0] for r in kept.collect()), coef, imp)


def probability_of_one(col: str = "probability"):
    return vector_to_array(F.col(col)).getItem(1)


def predict(model, mf: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Adds ``SCORE`` (probability of class 1) and ``PREDICTED_NO_SHOW``."""
    out = model.transform(mf)
    return (out.withColumn("SCORE", probability_of_one())
               .withColumn("PREDICTED_NO_SHOW", (F.col("SCORE") > F.lit(threshold)).cast("int")))


def auc_evaluator() -> BinaryClassificationEvaluator:
    # numBins=0: no down-sampling of the curve, the area is exact
    return BinaryClassificationEvaluator(labelCol=LABEL, rawPredictionCol="rawPrediction",
                                         metricName="areaUnderROC", numBins=0)


@dataclass
class CrossValidated:
    """``avgMetrics``: mean ROC AUC over the folds, one a parameter map; ``bestModel``: the best map's fit on all rows, made when it is asked for."""
    estimator: object
    rows: DataFrame
    maps: list[dict]
    avgMetrics: list[float]

    @cached_property
    def bestModel(self):
        best = max(range(len(self.maps)), key=lambda i: (self.avgMetrics[i], -i))
        return self.estimator.fit(self.rows, self.maps[best])


def cross_validate(estimator, mf_with_fold: DataFrame, param_maps=None, fold_col: str = "fold",
                   k: int = FOLDS, parallelism: int = 4) -> CrossValidated:
    """k-fold CV on an exact stratified fold column.

    ``mf_with_fold`` should be persisted: every fit reads it.  Up to
    ``parallelism`` fits, of any folds and maps, run at once as long as
    their rows together are no more than MAX_ROWS_AT_ONCE; larger frames
    keep all cores busy with one fit, and the memory is its own."""
    maps = param_maps if param_maps is not None else [{}]
    evaluator, fold = auc_evaluator(), F.col(fold_col)

    def score(job: tuple[int, int]) -> float:
        m, f = job
        model = estimator.fit(mf_with_fold.where(fold != f), maps[m])
        return float(evaluator.evaluate(model.transform(mf_with_fold.where(fold == f))))

    jobs = [(m, f) for f in range(k) for m in range(len(maps))]
    at_once = max(1, min(parallelism, len(jobs), MAX_ROWS_AT_ONCE // max(1, mf_with_fold.count())))
    with ThreadPool(at_once) as pool:
        got = dict(zip(jobs, pool.map(inheritable_thread_target(mf_with_fold.sparkSession)(score), jobs, 1), strict=True))
    return CrossValidated(estimator, mf_with_fold, maps, [sum(got[m, f] for f in range(k)) / k for m in range(len(maps))])


def compare_learners(train: DataFrame, features: list[str], target: str = TARGET, k: int = FOLDS, tree_depth: int = 30,
                     forest_trees: int = 100, forest_depth: int = 30, min_rows: int = 1, gbt_params: dict | None = None) -> DataFrame:
    """(model, mean_roc_auc): four learners on the same exact folds, balanced
    weights; logistic regression sees scaled features."""
    folded = materialize(sampling.stratified_kfold(train, k, target), "folds")
    w = {float(c): v for c, v in class_weights(train, target)["class_weight"].items()}
    scaled = encode.fit_scaling(train, features).transform(folded)
    learners = [("logistic", logistic_estimator(folded.count()), scaled),
                ("decision_tree", tree_estimator(max_depth=tree_depth, min_rows=min_rows), folded),
                ("random_forest", forest_estimator(num_trees=forest_trees, max_depth=forest_depth, min_rows=min_rows), folded),
                ("gbt", gbt_estimator(gbt_params), folded)]
    out = []
    for name, est, frame in learners:
        mf = learning_frame(frame, features, target, w, keep=["fold"]).persist()
        try:
            out.append((name, float(cross_validate(est, mf, k=k).avgMetrics[0])))
        finally:
            mf.unpersist()
    return train.sparkSession.createDataFrame(out, "model string, mean_roc_auc double")


def compare_resamplings(train: DataFrame, test: DataFrame, features: list[str], target: str = TARGET, key: str = KEY,
                        gbt_params: dict | None = None, seed: int = 123) -> DataFrame:
    """(method, roc_auc, f1): boosted trees trained on the original rows (with
    the positive-class weight) and on up-sampled, down-sampled and synthetic
    balanced rows (without it), all evaluated on the same test rows."""
    even = {0.0: 1.0, 1.0: 1.0}
    arms = {"original": (train, pos_weights(train, target)),
            "upsampled": (sampling.upsample(train, target, key, seed, 1), even),
            "downsampled": (sampling.downsample(train, target, key, seed, 0), even),
            "smote": (smote(train, features, target, key, 1, 5, 42), even)}
    test_mf = model_frame(test, features, target)
    out = []
    for name, (rows, w) in arms.items():
        rows = materialize(rows.select(*features, target), f"arm-{name}")
        model = fit_gbt(learning_frame(rows, features, target, w), gbt_params)
        pred = materialize(predict(model, test_mf).select(LABEL, "SCORE", "PREDICTED_NO_SHOW"), f"arm-{name}-predictions")
        m = evaluate.evaluate(pred, LABEL, "SCORE", "PREDICTED_NO_SHOW")
        got = {r["metric"]: r["value"] for r in m.collect()}
        out.append((name, got["roc_auc"], got["f1_1"]))
    return train.sparkSession.createDataFrame(out, "method string, roc_auc double, f1 double")


@dataclass
class Tuning:
    """``draws``: one row a draw with its parameters and mean ROC AUC; ``best``: the parameters of the best."""
    draws: DataFrame
    best: dict
    best_auc: float


def tune(train: DataFrame, features: list[str], target: str = TARGET, max_evals: int = MAX_EVALS, k: int = FOLDS,
         space: dict | None = None, seed: int = 42) -> Tuning:
    """``max_evals`` seeded draws from the search space, each scored by k-fold CV."""
    draws = random_draws(max_evals, seed, space)
    est = gbt_estimator()
    folded = materialize(sampling.stratified_kfold(train, k, target).select("fold", *features, target), "folds")
    mf = learning_frame(folded, features, target, pos_weights(train, target), keep=["fold"]).persist()
    try:
        scores = cross_validate(est, mf, gbt_param_maps(draws, est), k=k).avgMetrics
    finally:
        mf.unpersist()
    rows = [(i, *[float(d[p]) for p in SEARCH_SPACE], float(a)) for i, (d, a) in enumerate(zip(draws, scores, strict=True))]
    schema = "draw int, " + ", ".join(f"{p} double" for p in SEARCH_SPACE) + ", mean_roc_auc double"
    best = max(range(len(draws)), key=lambda i: (scores[i], -i))
    return Tuning(train.sparkSession.createDataFrame(rows, schema), draws[best], float(scores[best]))


def gbt_importance(model, features: list[str], train: DataFrame, target: str = TARGET, threshold: float = 0.01,
                   params: dict | None = None):
    """(importances with ``kept``, features kept, model refitted on them): the second selection."""
    spark = train.sparkSession
    imp = importance_frame(spark, importances(model, features))
    kept = sorted(r["Feature"] for r in threshold_features(imp, threshold, absolute=False).collect())
    refit = fit_gbt(learning_frame(train, kept, target, pos_weights(train, target)), params)
    return imp.withColumn("kept", (F.col("Importance") >= threshold).cast("int")), kept, refit


def random_draws(n: int, seed: int = 42, space: dict | None = None) -> list[dict]:
    """Seeded uniform draws from the original search space (integers as
    whole numbers).  Replaces the adaptive sampler; each draw is a grid point."""
    space = space or SEARCH_SPACE
    rng = random.Random(seed)
    draws = []
    for _ in range(n):
        d = {}
        for k, (lo, hi, kind) in space.items():
            d[k] = rng.randint(int(lo), int(hi)) if kind == "int" else rng.uniform(lo, hi)
        draws.append(d)
    return draws


def gbt_param_maps(draws: list[dict], estimator: GBTClassifier) -> list[dict]:
    maps = []
    for d in draws:
        ref = gbt_estimator(d)
        maps.append({estimator.getParam(p.name): ref.getOrDefault(p.name)
                     for p in (ref.maxIter, ref.maxDepth, ref.stepSize, ref.minInfoGain, ref.subsamplingRate,
                               ref.featureSubsetStrategy, ref.minInstancesPerNode, ref.cacheNodeIds)})
    return maps
