"""Registered queries: what is kept between runs -- committed versions, runs
that replace themselves, mergeable profiles and bucketed tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from truant.fixtures import SCORED_SQL, appointments, scored, with_ctes
from truant.operators import clean, history, profile, profile_state, sampling
from truant.plans import featurize, scoring, training, versions
from truant.plans.catalog import query
from truant.plans.oracle_sql import PREPROCESSED_SQL, split_ctes, target_encoding_ctes
from truant.schema import KEY, PATIENT, SCHEDULED
from truant.session import scratch_path
from truant.sources import tables

DATABASE = "truant_db"


@query("state_versions", with_ctes(
    "SELECT NEIGHBOURHOOD, CAST(n AS BIGINT) AS n, ROUND(value, 9) AS value FROM te",
    p=PREPROCESSED_SQL, **split_ctes("p", "sp"), train="SELECT * EXCLUDE (split) FROM sp WHERE split = 'train'", **target_encoding_ctes("train", "te")))
def q_state_versions(spark, sf):
    """A state is committed; a later run breaks off before its commit: the committed one is loaded."""
    root = scratch_path(spark, "states")
    p = training.prepare(appointments(spark, sf))
    versions.save(spark, root, {"feature_state": p.state.save})
    later = featurize.fit_feature_state(clean.preprocess(appointments(spark, sf)))  # of all rows, so not the same one
    later.save(f"{root}/feature_state/{versions.new_version()}")  # no manifest follows
    at = versions.paths(spark, root, ["feature_state"])
    return featurize.FeatureState.load(spark, at["feature_state"]).te.table.select("NEIGHBOURHOOD", "n", F.round("value", 9).alias("value"))


@query("write_predictions_twice", with_ctes(
    "SELECT APPOINTMENTID, run_id, 1 AS times, ROUND(CASE run_id WHEN 'a' THEN SCORE ELSE SCORE / 2 END, 9) AS SCORE"
    " FROM scored, (SELECT unnest(['a', 'b']) AS run_id)", scored=SCORED_SQL))
def q_write_predictions_twice(spark, sf):
    """Run a is written, then b, then a again with other scores, as a retry does: every run has its rows once, the last ones."""
    path = scratch_path(spark, "runs")
    s = scored(spark, sf).select(KEY, "SCORE")
    half = s.withColumn("SCORE", F.col("SCORE") / 2)
    for run, rows in (("a", half), ("b", half), ("a", s)):
        scoring.write_predictions(rows, path, run_id=run)
    return spark.read.parquet(path).groupBy(KEY, F.col("run_id").cast("string").alias("run_id")).agg(
        F.count(F.lit(1)).cast("int").alias("times"), F.round(F.max("SCORE"), 9).alias("SCORE"))


_PROFILED = ["AGE", "SMS_RECEIVED", "PATIENTID", "NEIGHBOURHOOD", "SCHEDULEDDAY", "GENDER", "NO_SHOW"]


def _profile_sql(load: str = "") -> str:
    out = []
    for c in _PROFILED:
        number = {"SCHEDULEDDAY": "CAST(epoch_us(SCHEDULEDDAY) AS DOUBLE)"}.get(c, f"CAST({c} AS DOUBLE)")
        text = c in ("NEIGHBOURHOOD", "GENDER", "NO_SHOW")
        moments = "NULL::DOUBLE AS mean, NULL::DOUBLE AS std_pop, NULL::DOUBLE AS std_samp, NULL::DOUBLE AS least, NULL::DOUBLE AS greatest" if text else (
            f"ROUND(AVG({number}), 6) AS mean, ROUND(STDDEV_POP({number}) / GREATEST(1, ABS(AVG({number}))), 9) AS std_pop,"
            f" ROUND(STDDEV_SAMP({number}) / GREATEST(1, ABS(AVG({number}))), 9) AS std_samp, MIN({number}) AS least, MAX({number}) AS greatest")
        out.append(f"SELECT '{c}' AS \"column\", COUNT(*) AS rows, COUNT(*) - COUNT({c}) AS nulls, {moments},"
                   f" {'MIN(' + c + ')' if text else 'NULL::VARCHAR'} AS least_text, {'MAX(' + c + ')' if text else 'NULL::VARCHAR'} AS greatest_text, 1 AS distinct_ok FROM appointments")
    return " UNION ALL ".join(out)


@query("profile_merged", with_ctes(_profile_sql()))
def q_profile_merged(spark, sf):
    """Profiles kept by month of scheduling, one month written twice, merged: the profile of the whole.

    Deviations are shown relative to the mean; the distinct estimate has to be within 5 % of the exact count."""
    a = appointments(spark, sf).select(*_PROFILED)
    path = scratch_path(spark, "profiles")
    month = F.date_format(SCHEDULED, "yyyy-MM")
    state = profile_state.profile_state(a, month)
    profile_state.write_state(state, path)
    first = state.agg(F.min("load")).scalar()
    profile_state.write_state(state.where(F.col("load") == first), path)  # a load that is run again
    merged = profile_state.profile(profile_state.merge_states(profile_state.read_state(spark, path)), 12)
    exact = profile.distinct_count(a).select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"n_distinct_{c}").alias("exact")) for c in _PROFILED])))
    size = F.greatest(F.lit(1.0), F.abs("mean"))
    return merged.join(exact, "column").select(
        "column", "rows", "nulls", F.round("mean", 6).alias("mean"), F.round(F.col("std_pop") / size, 9).alias("std_pop"),
        F.round(F.col("std_samp") / size, 9).alias("std_samp"), "least", "greatest", "least_text", "greatest_text",
        (F.abs(F.col("distinct_estimate") - F.col("exact")) <= 0.05 * F.col("exact") + 1).cast("int").alias("distinct_ok"))


def _bucketed(spark, df, keys, name, **options):
    full = tables.create_bucketed(df, f"{name}_{uuid.uuid4().hex[:8]}", keys, 8, DATABASE, scratch_path(spark, name), **options)
    return spark.table(full)


@query("bucketed_leak_check", with_ctes(
    "SELECT s.APPOINTMENTID FROM sp s WHERE s.split = 'test' AND s.APPOINTMENTID IN (SELECT APPOINTMENTID FROM p)",
    **split_ctes("appointments", "sp"), p=PREPROCESSED_SQL))
def q_bucketed_leak_check(spark, sf):
    """leak_check on two tables bucketed by the key: joined bucket by bucket."""
    a = appointments(spark, sf)
    unlabelled = _bucketed(spark, sampling.stratified_split(a).where("split = 'test'").drop("split"), [KEY], "unlabelled")
    training_rows = _bucketed(spark, clean.preprocess(a), [KEY], "training")
    return scoring.leak_check(unlabelled, training_rows).select(KEY)


@query("bucketed_history", with_ctes(
    "SELECT APPOINTMENTID, PATIENTID, CAST(COUNT(*) OVER (PARTITION BY PATIENTID ORDER BY SCHEDULEDDAY,"
    " APPOINTMENTID ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT) AS prior_appointments FROM appointments"))
def q_bucketed_history(spark, sf):
    """prior_appointments on a table bucketed by patient and sorted by time: each bucket is windowed where it lies.

    Patients go by a whole number there: Spark normalises fractions (-0.0, NaN) before it groups, which no bucket matches."""
    a = appointments(spark, sf).select(KEY, PATIENT, SCHEDULED, F.col(PATIENT).cast("long").alias("patient_no"))
    t = _bucketed(spark, a, ["patient_no"], "by_patient", sort_by=["patient_no", SCHEDULED])
    return history.prior_appointments(t, patient="patient_no").select(KEY, PATIENT, "prior_appointments")
