"""The command-line jobs end to end on the smallest tables."""

import os
import tempfile

from pyspark.sql import functions as F

from conftest import SF_SMALL
from truant import jobs
from truant.fixtures import appointments
from truant.operators import clean, sampling
from truant.sources import tables


def test_train_then_score_then_eda(spark):
    d = tempfile.mkdtemp(prefix="truant-jobs-")
    raw = appointments(spark, SF_SMALL)
    raw.write.parquet(f"{d}/appointments")
    sim = sampling.stratified_split(raw)
    tables.write_csv(clean.blank_target(sim.where(F.col("split") == "test").drop("split")), f"{d}/sim")
    jobs.main(["train", "--input", f"{d}/appointments", "--model-dir", f"{d}/model",
               "--params", '{"n_estimators": 5, "max_depth": 3}', "--no-select"])
    assert os.path.isdir(f"{d}/model/model") and os.path.isdir(f"{d}/model/feature_state")
    jobs.main(["score", "--input", f"{d}/sim", "--format", "csv", "--model-dir", f"{d}/model",
               "--output", f"{d}/pred"])
    pred = spark.read.parquet(f"{d}/pred")
    assert pred.count() > 0 and set(pred.select("PREDICTED_NO_SHOW").distinct().toPandas().iloc[:, 0]) <= {0, 1}
    jobs.main(["eda", "--input", f"{d}/appointments", "--output", f"{d}/eda"])
    assert spark.read.parquet(f"{d}/eda/by_age_group").count() == 5


def test_tune_then_train_then_evaluate(spark):
    d = tempfile.mkdtemp(prefix="truant-jobs-")
    appointments(spark, SF_SMALL).write.parquet(f"{d}/appointments")
    from truant.operators import models
    from truant.plans import training
    space = models.SEARCH_SPACE
    try:
        models.SEARCH_SPACE = {**space, "n_estimators": (2, 3, "int"), "max_depth": (2, 3, "int")}
        jobs.main(["tune", "--input", f"{d}/appointments", "--output", f"{d}/tuned", "--evals", "2", "--folds", "2"])
    finally:
        models.SEARCH_SPACE = space
    draws = spark.read.parquet(f"{d}/tuned/draws")
    best = training.load_params(spark, f"{d}/tuned/best")
    assert draws.count() == 2 and best["n_estimators"] in (2, 3)
    jobs.main(["train", "--input", f"{d}/appointments", "--model-dir", f"{d}/model", "--tuned", f"{d}/tuned/best", "--no-select"])
    jobs.main(["evaluate", "--input", f"{d}/appointments", "--model-dir", f"{d}/model", "--output", f"{d}/metrics"])
    got = {r.metric: r.value for r in spark.read.parquet(f"{d}/metrics").collect()}
    assert 0.5 < got["roc_auc"] <= 1 and got["c00"] > 0
    jobs.main(["sample", "--input", f"{d}/appointments", "--output", f"{d}/sample", "--rest", f"{d}/rest"])
    assert tables.scan_csv(spark, f"{d}/sample").count() + spark.read.parquet(f"{d}/rest").count() == 1000
