"""What is kept between runs: versions, runs of predictions, mergeable profiles, bucketed tables."""

import os
import random
import shutil
import statistics

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import SF_SMALL
from truant.fixtures import appointments
from truant.operators import history, profile_state
from truant.plans import scoring, versions
from truant.schema import KEY, PATIENT, SCHEDULED
from truant.sources import tables


# ---------------------------------------------------------------- versions
def _write(spark, text):
    return lambda path: spark.createDataFrame([(text,)], "t string").coalesce(1).write.text(path)


def _read(spark, root, parts=("state", "model"), version=None):
    return {p: spark.read.text(path).first()[0] for p, path in versions.paths(spark, root, parts, version).items()}


def test_newest_complete_version_is_loaded(spark, tmp_path):
    root = str(tmp_path / "m")
    first = versions.save(spark, root, {"state": _write(spark, "s1"), "model": _write(spark, "m1")})
    second = versions.save(spark, root, {"state": _write(spark, "s2"), "model": _write(spark, "m2")})
    assert _read(spark, root) == {"state": "s2", "model": "m2"}
    assert _read(spark, root, version=first) == {"state": "s1", "model": "m1"}
    assert versions.committed(spark, root) == [second, first]


def test_run_broken_off_between_the_parts(spark, tmp_path):
    root = str(tmp_path / "m")
    versions.save(spark, root, {"state": _write(spark, "s1"), "model": _write(spark, "m1")})

    def lost(path):
        raise RuntimeError("driver lost")

    with pytest.raises(RuntimeError):
        versions.save(spark, root, {"state": _write(spark, "s2"), "model": lost})
    assert len(os.listdir(f"{root}/state")) == 2  # the half-written folder is there
    assert _read(spark, root) == {"state": "s1", "model": "m1"}


def test_changed_or_lost_files_are_noticed(spark, tmp_path):
    root = str(tmp_path / "m")
    first = versions.save(spark, root, {"state": _write(spark, "s1"), "model": _write(spark, "m1")})
    second = versions.save(spark, root, {"state": _write(spark, "s2"), "model": _write(spark, "m2")})
    part = next(f for f in os.listdir(f"{root}/model/{second}") if f.startswith("part"))
    shutil.move(f"{root}/model/{second}/{part}", tmp_path / "taken")
    assert _read(spark, root) == {"state": "s1", "model": "m1"}
    shutil.move(f"{root}/model/{first}", tmp_path / "taken-too")
    with pytest.raises(FileNotFoundError):
        versions.paths(spark, root, ["state", "model"])
    with pytest.raises(FileNotFoundError):
        versions.paths(spark, root, ["state"], second)


def test_manifest_that_was_not_finished(spark, tmp_path):
    root = str(tmp_path / "m")
    versions.save(spark, root, {"state": _write(spark, "s1")}, "0001")
    _write(spark, "s2")(f"{root}/state/0002")
    os.makedirs(f"{root}/manifests/0002/_temporary/0")
    assert _read(spark, root, ["state"]) == {"state": "s1"}


def test_folder_without_versions_is_read_as_it_is(spark, tmp_path):
    assert versions.paths(spark, str(tmp_path), ["model"]) == {"model": f"{tmp_path}/model"}


# ------------------------------------------------------------- predictions
@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_run_written_twice_has_its_rows_once(spark, tmp_path, fmt):
    path = str(tmp_path / "p")
    rows = spark.range(50).selectExpr("id as APPOINTMENTID", "id / 100 as SCORE")
    scoring.write_predictions(rows, path, fmt, "run1")
    scoring.write_predictions(rows.limit(7), path, fmt, "run2")
    scoring.write_predictions(rows.limit(30), path, fmt, "run1")
    read = spark.read.parquet(path) if fmt == "parquet" else spark.read.option("header", True).csv(path)
    assert {r.run_id: r["count"] for r in read.groupBy("run_id").count().collect()} == {"run1": 30, "run2": 7}


def test_runs_without_an_id_are_kept_apart(spark, tmp_path):
    rows = spark.range(5).selectExpr("id as APPOINTMENTID")
    ids = {scoring.write_predictions(rows, str(tmp_path / "p")) for _ in range(2)}
    assert len(ids) == 2 and spark.read.parquet(str(tmp_path / "p")).count() == 10


# ----------------------------------------------------------------- profile
def _merged(states):
    return {r["column"]: r for r in profile_state.profile(profile_state.merge_states(states)).collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_parts_merge_to_the_whole(spark, seed):
    pick = random.Random(seed)
    rows = [(i, pick.choice([None, 1e9 + pick.random()]), pick.choice([None, "a", "b", f"x{i}"]), pick.randint(0, 3)) for i in range(400)]
    df = spark.createDataFrame(rows, "k long, x double, t string, load int").select("load", "k", "x", "t", F.lit(None).cast("int").alias("none"))
    cols = ["k", "x", "t", "none"]
    parts = profile_state.profile_state(df, F.col("load"), cols)
    got, whole = _merged(parts), _merged(profile_state.profile_state(df, "all", cols))
    x = [r[1] for r in rows if r[1] is not None]
    for c in cols:
        assert all(got[c][f] == whole[c][f] for f in ("rows", "nulls", "least", "greatest", "least_text", "greatest_text"))
    assert got["x"].mean == pytest.approx(statistics.fmean(x), rel=1e-12)
    # a sum of squares would lose all digits here: the deviations are 1e-10 of the values
    assert got["x"].std_pop == pytest.approx(statistics.pstdev(x), rel=1e-6)
    assert got["x"].std_samp == pytest.approx(statistics.stdev(x), rel=1e-6)
    assert abs(got["k"].distinct_estimate - 400) <= 20 and got["none"].nulls == 400 and got["none"].mean is None and got["none"].distinct_estimate == 0


def test_merging_is_associative(spark):
    df = spark.range(300).selectExpr("id % 7 as load", "id * id as v")
    s = profile_state.profile_state(df, F.col("load"), ["v"])
    halves = [profile_state.merge_states(s.where(c)).withColumn("load", F.lit(c)) for c in ("load < 3", "load >= 3")]
    a, b = _merged(halves[0].unionByName(halves[1]))["v"], _merged(s)["v"]
    assert (a.rows, a.mean, a.distinct_estimate) == (b.rows, pytest.approx(b.mean), b.distinct_estimate) and a.std_pop == pytest.approx(b.std_pop)


def test_load_written_again_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "profiles")
    for load, n in (("2016-01", 10), ("2016-02", 5), ("2016-01", 20)):
        profile_state.write_state(profile_state.profile_state(spark.range(n), load), path)
    kept = profile_state.read_state(spark, path)
    assert {r.load: r.rows for r in kept.collect()} == {"2016-01": 20, "2016-02": 5}
    assert _merged(kept)["id"].rows == 25
    text = kept.where("load = '2016-02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in text and "2016-02" in text.split("PartitionFilters: [")[1].split("]")[0]


def test_load_without_rows_has_no_state(spark):
    none = profile_state.profile_state(spark.range(0), "x")
    assert none.count() == 0 and _merged(none) == {}
    assert _merged(none.unionByName(profile_state.profile_state(spark.range(3), "y")))["id"].rows == 3


# ---------------------------------------------------------------- bucketed
def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_tables_are_joined_without_an_exchange(spark):
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = entry.queries()["bucketed_leak_check"](spark, SF_SMALL)
        assert "SortMergeJoin" in _plan(df) and "Exchange" not in _plan(df)
        plain = scoring.leak_check(appointments(spark, SF_SMALL), appointments(spark, SF_SMALL))
        assert "Exchange hashpartitioning" in _plan(plain)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)


def test_history_on_a_bucketed_table_has_no_exchange(spark):
    df = entry.queries()["bucketed_history"](spark, SF_SMALL)
    assert "Window" in _plan(df) and "Exchange" not in _plan(df)


def test_buckets_keep_null_keys_and_repeated_rows(spark, tmp_path):
    rows = [(1.0, 1), (None, 2), (None, 3), (1.0, 1), (2.0, 4)]
    df = spark.createDataFrame(rows, f"{PATIENT} double, {KEY} long").withColumn(SCHEDULED, F.lit("2016-01-01").cast("timestamp"))
    t = spark.table(tables.create_bucketed(df, "nulls_and_copies", [PATIENT], 4, "truant_db", str(tmp_path / "t")))
    assert t.count() == 5
    assert sorted(r.prior_appointments for r in history.prior_appointments(t).collect()) == [0, 0, 0, 0, 1]
    spark.sql("DROP TABLE truant_db.nulls_and_copies")
