"""Training, frozen state persistence, and stream scoring equal to batch."""

import os
import tempfile

from pyspark.sql import functions as F

from conftest import SF_SMALL
from truant.fixtures import appointments
from truant.operators import clean, sampling
from truant.plans import featurize, scoring, training
from truant.sources import tables
from truant.streaming import score as stream


def test_train_save_load_and_stream_equals_batch(spark):
    raw = appointments(spark, SF_SMALL)
    t = training.train(raw, params={"n_estimators": 5, "max_depth": 3}, select=False)
    assert 0.5 < t.metrics["roc_auc"] <= 1.0
    d = tempfile.mkdtemp(prefix="truant-model-")
    t.prepared.state.save(f"{d}/feature_state")
    t.model.write().overwrite().save(f"{d}/model")
    state, model = scoring.load(spark, d)
    assert state.categories == t.prepared.state.categories and state.drop_years == t.prepared.state.drop_years
    sim = sampling.stratified_split(raw)
    sim = clean.blank_target(sim.where(F.col("split") == "test").drop("split"))
    batch = scoring.score_frame(sim, state, model, stamp_col=None)
    src, out, ck = (os.path.join(d, n) for n in ("in", "out", "ck"))
    tables.write_csv(sim.repartition(3), src)
    stream.score_stream(spark, src, state, model, out, ck)
    streamed = spark.read.parquet(out)
    cols = ["APPOINTMENTID", "PREDICTED_NO_SHOW"]
    assert streamed.select(cols).exceptAll(batch.select(cols)).count() == 0
    assert batch.select(cols).exceptAll(streamed.select(cols)).count() == 0
    assert streamed.count() == batch.count() > 0


def test_features_do_not_depend_on_frame(spark):
    raw = appointments(spark, SF_SMALL)
    pre = clean.preprocess(raw)
    train, test = sampling.split_frames(pre)
    state = featurize.fit_feature_state(train)
    a = featurize.apply_features(train, state)
    b = featurize.apply_features(test.limit(3), state)
    assert a.columns == b.columns


def test_request_stream_scores_good_lines_and_diverts_bad_ones(spark):
    import json
    raw = appointments(spark, SF_SMALL)
    t = training.train(raw, params={"n_estimators": 3, "max_depth": 2}, select=False, seed=7)
    d = tempfile.mkdtemp(prefix="truant-req-")
    sim = clean.blank_target(raw.limit(40))
    from truant.sources import requests
    req = requests.encode_requests(sim, F.floor(F.col("APPOINTMENTID") / 10).cast("long"))
    bad = spark.createDataFrame([(999999, json.dumps({"data": "HEADER\nnot,a,valid,row"}))],
                                "request_id long, body string")
    req.unionByName(bad).write.json(f"{d}/in")
    out, ck, err = f"{d}/out", f"{d}/ck", f"{d}/err"
    stream.score_requests_stream(spark, f"{d}/in", t.prepared.state, t.model, out, ck, err)
    scored = spark.read.parquet(out)
    batch = scoring.score_frame(sim, t.prepared.state, t.model, stamp_col=None)
    assert scored.select("APPOINTMENTID").exceptAll(batch.select("APPOINTMENTID")).count() == 0
    assert scored.count() == batch.count()
    errors = spark.read.parquet(err).collect()
    assert [(r.request_id, r.line_no, r.error) for r in errors if r.request_id == 999999] == [(999999, 1, "the header has no APPOINTMENTID")]
    # every row is scored, with its request, or explained
    assert scored.where("request_id IS NULL").count() == 0
    assert scored.count() + len(errors) - 1 == sim.count()


def test_preparation_reads_the_raw_rows_once(spark):
    raw, read = appointments(spark, SF_SMALL), spark.sparkContext.accumulator(0)
    n = raw.count()

    def run(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b
    p = training.prepare(raw.mapInArrow(run, raw.schema))
    assert read.value == n
    plain = training.prepare(raw)
    assert p.features == plain.features and p.train.columns == plain.train.columns and p.train.columns[-1] == "NO_SHOW"
    assert p.train.exceptAll(plain.train).count() == 0 and p.test.exceptAll(plain.test).count() == 0
    split = sampling.stratified_split(clean.preprocess(raw)).where("split = 'test'")
    assert {r[0] for r in p.test.select("APPOINTMENTID").collect()} == {r[0] for r in split.select("APPOINTMENTID").collect()}
    assert 0 < p.hashed.count() == p.train.count()
