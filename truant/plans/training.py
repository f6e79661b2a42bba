"""Training job: preprocess -> exact split -> frozen features -> selection ->
boosted trees -> evaluation -> saved state and model.

Cleaned rows and both model tables are written once as Parquet in the shared
folder, so the learners' many passes read only their columns of them, and a
lost executor re-reads the files, not the raw scan.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from truant.operators import clean, encode, evaluate, models, sampling
from truant.plans import featurize, versions
from truant.schema import KEY, TARGET
from truant.session import materialize, side_by_side


@dataclass
class Prepared:
    train: DataFrame            # model table of the training split
    test: DataFrame             # model table of the test split
    state: featurize.FeatureState
    features: list[str]
    extra: dict = field(default_factory=dict)
    hashed: DataFrame | None = None  # train with sampling.KEY_HASH by models.TREE_SEED, if the split was drawn by it


def prepare(raw: DataFrame, test_size: float = 0.2, seed: int = 42) -> Prepared:
    """Split, fit the frozen state, build and write both model tables.

    The raw rows are read once: cleaned rows are written with the hashes of
    their keys, and the split is then a projection of that table."""
    pre = materialize(sampling.with_hash(clean.preprocess(raw), KEY, seed), "preprocessed")
    split = sampling.stratified_split(pre, TARGET, test_size, seed, hashed=sampling.KEY_HASH)
    train = split.where(F.col("split") == "train").drop("split")
    test = split.where(F.col("split") == "test").drop("split", sampling.KEY_HASH)
    state = featurize.fit_feature_state(train)
    hashed, ftest = side_by_side(raw.sparkSession, lambda: materialize(featurize.apply_features(train, state), "train"),
                                 lambda: materialize(featurize.apply_features(test, state), "test"))
    ftrain = hashed.drop(sampling.KEY_HASH)
    return Prepared(ftrain, ftest, state, featurize.feature_columns(ftrain), hashed=hashed if seed == models.TREE_SEED else None)


def scaled(p: Prepared) -> tuple[encode.Scaling, DataFrame, DataFrame]:
    sc = encode.fit_scaling(p.train, p.features)
    return sc, sc.transform(p.train), sc.transform(p.test)


def select_features(p: Prepared, threshold: float = 0.01, **tree) -> models.Selection:
    """``tree``: tree_depth, tree_min_rows of models.select_important."""
    sel = models.select_important(lambda: scaled(p)[1], p.train, p.features, TARGET, threshold, **tree)
    p.state.selected = sel.features
    return sel


@dataclass
class Trained:
    prepared: Prepared
    model: object
    features: list[str]
    predictions: DataFrame      # test split: key, label, SCORE, PREDICTED_NO_SHOW
    metrics: dict


def train(raw: DataFrame, params: dict | None = None, select: bool = True, test_size: float = 0.2,
          seed: int = 42, out_dir: str | None = None, scale_pos_weight: float | None = None, **tree) -> Trained:
    """``params`` override models.DEFAULT_GBT_PARAMS (the original's defaults)."""
    params = {**models.DEFAULT_GBT_PARAMS, **(params or {})}
    p = prepare(raw, test_size, seed)
    feats = select_features(p, **tree).features if select else p.features
    p.state.selected = feats
    w = models.pos_weights(p.train, TARGET, scale_pos_weight)
    model = models.fit_gbt(models.learning_frame(p.train, feats, TARGET, w), params)  # which keeps its rows itself
    test_mf = models.model_frame(p.test, feats, TARGET, keep=[KEY])
    pred = materialize(models.predict(model, test_mf).select(KEY, F.col("label").cast("int").alias("label"),
                                                             "SCORE", "PREDICTED_NO_SHOW"), "predictions")
    got = {r["metric"]: r["value"] for r in evaluate.evaluate(pred, pred="PREDICTED_NO_SHOW").collect()}
    metrics = {"roc_auc": got["roc_auc"], "pr_auc": got["pr_auc"], "f1": got["f1_1"],
               "accuracy": got["accuracy"], "n_features": len(feats)}
    if out_dir:
        p.state.extra["params"] = params
        versions.save(raw.sparkSession, out_dir, {"feature_state": p.state.save, "model": lambda path: model.write().save(path)})
    return Trained(p, model, feats, pred, metrics)


def save_params(spark, params: dict, path: str) -> None:
    """The best parameters of a tuning run, as one line of JSON in the shared store."""
    spark.createDataFrame([(json.dumps(params),)], "params string").coalesce(1).write.mode("overwrite").text(path)


def load_params(spark, path: str) -> dict:
    return json.loads(spark.read.text(path).first()[0])
