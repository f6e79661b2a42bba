"""Scoring job: saved feature state + model applied to new rows.

Training, batch scoring and stream scoring share ``featurize.apply_features``
so the three cannot drift apart.
"""

from __future__ import annotations

import uuid

from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from truant.functions.dates import run_stamp
from truant.operators import clean, evaluate, models, sampling
from truant.plans import featurize, versions
from truant.schema import KEY, TARGET
from truant.sources import tables


def load(spark: SparkSession, model_dir: str, version: str | None = None):
    """Feature state and model of one committed version, the newest complete one unless it is named."""
    at = versions.paths(spark, model_dir, ("feature_state", "model"), version)
    return featurize.FeatureState.load(spark, at["feature_state"]), GBTClassificationModel.load(at["model"])


def score_frame(raw: DataFrame, state: featurize.FeatureState, model, threshold: float = 0.5,
                stamp_col: str | None = "run_stamp", keep: list[str] | None = None) -> DataFrame:
    """Unlabelled appointment rows -> key, selected features, prediction,
    after the columns ``keep`` of the input.

    Works on a batch or a streaming frame (only stateless steps and a
    broadcast lookup of the frozen encoding table)."""
    keep = keep or []
    pre = clean.preprocess(raw, is_simulated=True)
    f = featurize.apply_features(pre, state)
    feats = state.selected or [c for c in featurize.feature_columns(f) if c not in keep]
    mf = models.model_frame(f, feats, target="__no_target__", keep=[*keep, KEY])
    out = models.predict(model, mf, threshold).select(*keep, KEY, *feats, "SCORE", "PREDICTED_NO_SHOW")
    if stamp_col:
        out = out.withColumn(stamp_col, run_stamp(F.current_timestamp()))
    return out


def write_predictions(pred: DataFrame, path: str, fmt: str = "parquet", run_id: str | None = None) -> str:
    """Partitioned by ``run_id``, so that later reads prune by run and a run
    that is written again replaces its own rows and no others.  Without a
    ``run_id`` the call is a run of its own.  Returns the run's id."""
    run_id = run_id or uuid.uuid4().hex
    w = pred.withColumn("run_id", F.lit(run_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id")
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.parquet(path)
    return run_id


def score_batch(spark: SparkSession, raw: DataFrame, model_dir: str, out_path: str | None = None, run_id: str | None = None) -> DataFrame:
    state, model = load(spark, model_dir)
    pred = score_frame(raw, state, model)
    if out_path:
        write_predictions(pred, out_path, run_id=run_id)
    return pred


def evaluate_saved(spark: SparkSession, raw: DataFrame, model_dir: str) -> DataFrame:
    """(metric, value): a saved state and model evaluated on labelled rows."""
    state, model = load(spark, model_dir)
    labelled = clean.preprocess(raw).select(KEY, F.col(TARGET).alias("label"))
    scored = score_frame(raw, state, model, stamp_col=None).join(labelled, KEY)
    return evaluate.evaluate(scored, "label", "SCORE", "PREDICTED_NO_SHOW")


def leak_check(unlabelled: DataFrame, training: DataFrame, key: str = KEY) -> DataFrame:
    """Scoring rows whose key also appears in the training rows (semi join;
    the join shuffles both sides on the key, no side is assumed small)."""
    return unlabelled.join(training.select(key), key, "left_semi")


def disjoint_from(unlabelled: DataFrame, training: DataFrame, key: str = KEY) -> DataFrame:
    """Training rows that are not in the unlabelled set, so that no row is
    both learned from and scored."""
    return training.join(unlabelled.select(key), key, "left_anti")


def three_way(raw: DataFrame, unlabelled_size: float = 0.2, test_size: float = 0.2, seed: int = 42) -> DataFrame:
    """``raw`` with ``part``: 'unlabelled', 'test' or 'train', disjoint by key.

    The unlabelled sample is drawn first, by its own seed; the rest is
    preprocessed and split.  Rows that preprocessing rejects are in no part.
    """
    tagged = sampling.stratified_split(raw, TARGET, unlabelled_size, seed + 1, out="part")
    unlabelled = clean.blank_target(tagged.where("part = 'test'").drop("part"))
    rest = clean.preprocess(tagged.where("part = 'train'").drop("part"))
    parts = sampling.stratified_split(rest, TARGET, test_size, seed, out="part")
    scored = unlabelled.drop("PATIENTID").withColumn(TARGET, F.lit(None).cast("int")).withColumn("part", F.lit("unlabelled"))
    return parts.unionByName(scored)


def write_unlabelled(raw: DataFrame, path: str, size: float = 0.2, seed: int = 42) -> DataFrame:
    """The unlabelled set: a stratified sample of ``raw`` with the target blanked,
    written as CSV; returns the rows left for training."""
    tagged = sampling.stratified_split(raw, TARGET, size, seed)
    sample = clean.blank_target(tagged.where("split = 'test'").drop("split"))
    tables.write_csv(sample, path)
    return disjoint_from(sample, raw)
