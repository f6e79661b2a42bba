"""Registered queries: feature functions, encoders, scaling, feature table."""

from __future__ import annotations

from pyspark.sql import functions as F

from truant.fixtures import appointments, with_ctes
from truant.functions.bands import age_bucket, gender_age
from truant.functions.dates import date_part_columns, days_till_appointment, run_stamp
from truant.operators import clean, encode, profile, sampling
from truant.plans import featurize
from truant.plans.catalog import query
from truant.schema import KEY
from truant.plans.oracle_sql import (AGE_BUCKET_SQL, DAYS_TILL_SQL, FLAGS, GENDER_AGE_CATEGORIES,
                                     GENDER_AGE_SQL, PREPROCESSED_SQL, features_select, split_ctes,
                                     target_encoding_ctes)

D = 9  # digits kept for doubles in compared outputs


def _pre(spark, sf):
    return clean.preprocess(appointments(spark, sf))


def _split(spark, sf):
    """Train and test rows: projections of one scan by the split's borders."""
    s = sampling.stratified_split(_pre(spark, sf))
    return s.where(F.col("split") == "train").drop("split"), s.where(F.col("split") == "test").drop("split")


def _state(spark, sf):
    train, test = _split(spark, sf)
    return train, test, featurize.fit_feature_state(train)


_SPLIT = dict(p=PREPROCESSED_SQL, **split_ctes("p", "sp"),
              train="SELECT * EXCLUDE (split) FROM sp WHERE split = 'train'",
              test="SELECT * EXCLUDE (split) FROM sp WHERE split = 'test'")
_TE = dict(_SPLIT, **target_encoding_ctes("train", "te"))


@query("days_till_appointment", with_ctes(
    f"SELECT APPOINTMENTID, {DAYS_TILL_SQL} AS DAYS_TILL_APPOINTMENT FROM appointments"))
def q_days_till(spark, sf):
    return appointments(spark, sf).select(
        "APPOINTMENTID", days_till_appointment().alias("DAYS_TILL_APPOINTMENT"))


@query("date_parts", with_ctes(
    "SELECT APPOINTMENTID, " + ", ".join(
        f"CAST({fn}({c}) AS INT) AS {c}_{p}" for c in ("SCHEDULEDDAY", "APPOINTMENTDAY")
        for p, fn in (("YEAR", "year"), ("MONTH", "month"), ("DAY", "day"))) + " FROM appointments"))
def q_date_parts(spark, sf):
    return appointments(spark, sf).select("APPOINTMENTID", *[e.alias(n) for n, e in date_part_columns().items()])


@query("age_bucket", with_ctes(f"SELECT APPOINTMENTID, AGE, {AGE_BUCKET_SQL} AS AGE_BUCKET FROM appointments"))
def q_age_bucket(spark, sf):
    return appointments(spark, sf).select("APPOINTMENTID", "AGE", age_bucket("AGE").alias("AGE_BUCKET"))


@query("gender_age", with_ctes(f"SELECT APPOINTMENTID, {GENDER_AGE_SQL} AS GENDER_AGE FROM appointments"))
def q_gender_age(spark, sf):
    return appointments(spark, sf).select("APPOINTMENTID", gender_age().alias("GENDER_AGE"))


@query("run_stamp", with_ctes(
    "SELECT APPOINTMENTID, strftime(timezone('America/Vancouver', timezone('UTC', SCHEDULEDDAY)),"
    " '%Y%m%d_%H%M%S') AS run_stamp FROM appointments"))
def q_run_stamp(spark, sf):
    return appointments(spark, sf).select("APPOINTMENTID", run_stamp("SCHEDULEDDAY").alias("run_stamp"))


_DUMMIES_SQL = ", ".join(f"CASE WHEN {GENDER_AGE_SQL} = '{c}' THEN 1 ELSE 0 END AS \"GENDER_AGE_{c}\""
                         for c in GENDER_AGE_CATEGORIES[1:])


@query("one_hot", with_ctes(f"SELECT APPOINTMENTID, {_DUMMIES_SQL} FROM p", p=PREPROCESSED_SQL))
def q_one_hot(spark, sf):
    p = _pre(spark, sf).select("APPOINTMENTID", gender_age().alias("GENDER_AGE"))
    cats = encode.fit_categories(p, "GENDER_AGE")
    return encode.one_hot(p, "GENDER_AGE", cats)


@query("target_encode", with_ctes(
    f"SELECT NEIGHBOURHOOD, CAST(n AS BIGINT) AS n, ROUND(mean, {D}) AS mean, ROUND(value, {D}) AS value FROM te",
    **_TE))
def q_target_encode(spark, sf):
    train, _ = _split(spark, sf)
    te = encode.fit_target_encoding(train, "NEIGHBOURHOOD", "NO_SHOW")
    return te.table.select("NEIGHBOURHOOD", "n", F.round("mean", D).alias("mean"),
                           F.round("value", D).alias("value"))


@query("target_encode_m", with_ctes(
    f"SELECT NEIGHBOURHOOD, ROUND((n * mean + 10.0 * prior) / (n + 10.0), {D}) AS value FROM te_stats, te_prior",
    **_TE))
def q_target_encode_m(spark, sf):
    train, _ = _split(spark, sf)
    te = encode.fit_target_encoding_m(train, "NEIGHBOURHOOD", "NO_SHOW", 10.0)
    return te.table.select("NEIGHBOURHOOD", F.round("value", D).alias("value"))


@query("lookup_target_encoding", with_ctes(
    f"SELECT s.APPOINTMENTID, ROUND(COALESCE(t.value, (SELECT prior FROM te_prior)), {D}) AS NEIGHBOURHOOD"
    " FROM test s LEFT JOIN te t ON s.NEIGHBOURHOOD = t.NEIGHBOURHOOD", **_TE))
def q_lookup_target_encoding(spark, sf):
    train, test = _split(spark, sf)
    te = encode.fit_target_encoding(train, "NEIGHBOURHOOD", "NO_SHOW")
    out = te.transform(test.select("APPOINTMENTID", "NEIGHBOURHOOD"))
    return out.select("APPOINTMENTID", F.round("NEIGHBOURHOOD", D).alias("NEIGHBOURHOOD"))


def _rounded(df):
    return df.select(*[F.round(c, D).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


@query("features_wide", with_ctes(features_select("test", "te"), **_TE))
def q_features_wide(spark, sf):
    """The model table of the test split with state frozen on the train split."""
    _, test, state = _state(spark, sf)
    return _rounded(featurize.apply_features(test, state))


@query("features_wide_train", with_ctes(features_select("train", "te"), **_TE))
def q_features_wide_train(spark, sf):
    train, _, state = _state(spark, sf)
    return _rounded(featurize.apply_features(train, state))


_FEATURE_COLS = (["GENDER", "AGE", "NEIGHBOURHOOD"] + FLAGS + ["DAYS_TILL_APPOINTMENT", "SCHEDULEDDAY_MONTH",
                 "SCHEDULEDDAY_DAY", "APPOINTMENTDAY_MONTH", "APPOINTMENTDAY_DAY"]
                 + [f"GENDER_AGE_{c}" for c in GENDER_AGE_CATEGORIES[1:]])
_FW = dict(_TE, ftrain=features_select("train", "te", digits=15), ftest=features_select("test", "te", digits=15))


def _q(c):
    return f'"{c}"'


_MOM_SQL = "SELECT " + ", ".join(
    f"AVG(CAST({_q(c)} AS DOUBLE)) AS {_q('m_' + c)}, "
    f"CASE WHEN COALESCE(STDDEV_POP(CAST({_q(c)} AS DOUBLE)), 0) > 0 THEN STDDEV_POP(CAST({_q(c)} AS DOUBLE))"
    f" ELSE 1.0 END AS {_q('s_' + c)}" for c in _FEATURE_COLS) + " FROM ftrain"


def _scaled_sql(src):
    return ("SELECT x.APPOINTMENTID, " + ", ".join(
        f"ROUND((x.{_q(c)} - mo.{_q('m_' + c)}) / mo.{_q('s_' + c)}, 6) AS {_q(c)}" for c in _FEATURE_COLS)
        + f", x.NO_SHOW FROM {src} x, mo")


@query("standard_scale", with_ctes(_scaled_sql("ftest"), **_FW, mo=_MOM_SQL))
def q_standard_scale(spark, sf):
    """Moments fitted on the train features, applied to the test features."""
    train, test, state = _state(spark, sf)
    ftrain = featurize.apply_features(train, state)
    ftest = featurize.apply_features(test, state)
    sc = encode.fit_scaling(ftrain, [c for c in ftrain.columns if c not in ("APPOINTMENTID", "NO_SHOW")])
    out = sc.transform(ftest)
    return out.select(*[F.round(c, 6).alias(c) if c in sc.mean else F.col(c) for c in out.columns])


@query("check_scaling", with_ctes(
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", ROUND(AVG({_q(c)}), 9) + 0.0 AS mean,"
        f" ROUND(STDDEV_POP({_q(c)}), 9) + 0.0 AS std_pop,"
        f" CAST(ABS(AVG({_q(c)})) <= 0.2 AND ABS(STDDEV_POP({_q(c)}) - 1) <= 0.2 AS INT) AS ok FROM sc"
        for c in _FEATURE_COLS),
    **_FW, mo=_MOM_SQL, sc=_scaled_sql("ftrain").replace(", 6) AS", ", 15) AS")))
def q_check_scaling(spark, sf):
    train, _, state = _state(spark, sf)
    ftrain = featurize.apply_features(train, state)
    cols = [c for c in ftrain.columns if c not in ("APPOINTMENTID", "NO_SHOW")]
    sc = encode.fit_scaling(ftrain, cols)
    return profile.check_scaling(sc.transform(ftrain), cols)


_SELECTED = ["DAYS_TILL_APPOINTMENT", "AGE", "NEIGHBOURHOOD", "SMS_RECEIVED", "NOT_IN_FRAME"]


@query("select_features", with_ctes(
    f"SELECT APPOINTMENTID, DAYS_TILL_APPOINTMENT, AGE, NEIGHBOURHOOD, SMS_RECEIVED, 0 AS NOT_IN_FRAME, NO_SHOW"
    f" FROM ({features_select('test', 'te')})", **_TE))
def q_select_features(spark, sf):
    """Fixed feature list; a feature absent from the frame is filled with 0."""
    _, test, state = _state(spark, sf)
    return _rounded(clean.select_features(featurize.apply_features(test, state), _SELECTED))


@query("one_hot_long", with_ctes(
    "SELECT APPOINTMENTID, index - 1 AS index FROM appointments JOIN"
    " (SELECT PATIENTID, CAST(dense_rank() OVER (ORDER BY CAST(CAST(PATIENTID AS BIGINT) AS VARCHAR)) - 1 AS BIGINT) AS index"
    "  FROM (SELECT DISTINCT PATIENTID FROM appointments)) USING (PATIENTID) WHERE index > 0"))
def q_one_hot_long(spark, sf):
    """One-hot positions of a column with as many values as there are patients."""
    a = appointments(spark, sf).select("APPOINTMENTID", F.col("PATIENTID").cast("long").alias("PATIENTID"))
    return encode.one_hot_long(a, "APPOINTMENTID", "PATIENTID", encode.category_index(a, "PATIENTID")).toDF("APPOINTMENTID", "index")


_ALIGNED = {"APPOINTMENTID": "bigint", "GENDER": "string", "SCHEDULEDDAY": "timestamp", "AGE": "int", "SMS_RECEIVED": "int"}


@query("align_report", with_ctes(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", '{t}' AS left_type, {'NULL' if c == 'GENDER' else chr(39) + 'string' + chr(39)} AS right_type, {i} AS left_place,"
    f" {'NULL' if c == 'GENDER' else i - (i > 2)} AS right_place, COUNT(*) AS right_rows,"
    f" {'NULL' if c == 'GENDER' else f'CAST(COUNT(*) FILTER (WHERE APPOINTMENTID % 9 = 4) AS BIGINT)' if c == 'AGE' else 'CAST(0 AS BIGINT)'} AS not_castable FROM appointments"
    for i, (c, t) in enumerate(_ALIGNED.items(), 1))
    + " UNION ALL SELECT 'EXTRA', NULL, 'int', NULL, 5, COUNT(*), NULL FROM appointments"))
def q_align_report(spark, sf):
    """A typed frame against its text form, one column missing, one too many, a ninth of the ages unreadable."""
    a = appointments(spark, sf).select(*_ALIGNED)
    text = a.select(*[F.when((F.col(KEY) % 9 == 4) & F.lit(c == "AGE"), F.lit("forty")).otherwise(F.col(c).cast("string")).alias(c) for c in _ALIGNED if c != "GENDER"])
    return clean.align_report(a, text.withColumn("EXTRA", F.lit(1)))
