"""Registered queries: chi-square, point-biserial and correlation."""

from __future__ import annotations

from pyspark.sql import functions as F

from truant.fixtures import appointments, with_ctes
from truant.functions.bands import gender_age
from truant.functions.dates import days_till_appointment
from truant.operators import clean, encode, models, newton, sampling, stats
from truant.plans.catalog import query
from truant.plans.catalog_features import _FEATURE_COLS, _TE, _state
from truant.plans.oracle_sql import DAYS_TILL_SQL, GENDER_AGE_SQL, PREPROCESSED_SQL, features_select, split_ctes
from truant.plans import featurize
from truant.session import materialize

D = 9


_TRAIN = dict(q=PREPROCESSED_SQL, **split_ctes("q", "sp"), p="SELECT * EXCLUDE (split) FROM sp WHERE split = 'train'")


def _train_ga(spark, sf):
    """The training split with the gender-age key."""
    return sampling.split_frames(clean.preprocess(appointments(spark, sf)))[0].withColumn("GENDER_AGE", gender_age())


def _chi_sql(a_sql: str, correction: bool, **rows: str) -> str:
    # Yates' correction applies to 2 x 2 tables only
    cell = ("CASE WHEN (SELECT COUNT(*) FROM r) = 2 AND (SELECT COUNT(*) FROM c) = 2"
            " THEN power(abs(o - E) - least(0.5, abs(o - E)), 2) / E ELSE power(o - E, 2) / E END"
            if correction else "power(o - E, 2) / E")
    return with_ctes(f"""
SELECT ROUND(SUM({cell}), {D}) AS statistic,
       CAST((SELECT COUNT(*) FROM r) - 1 AS BIGINT) * CAST((SELECT COUNT(*) FROM c) - 1 AS BIGINT) AS dof,
       CAST((SELECT n FROM n) AS BIGINT) AS n
FROM grid""", **(rows or dict(p=PREPROCESSED_SQL)),
        cells=f"SELECT {a_sql} AS a, NO_SHOW AS b, COUNT(*) AS o FROM p WHERE {a_sql} IS NOT NULL GROUP BY 1, 2",
        r="SELECT a, SUM(o) AS rt FROM cells GROUP BY 1",
        c="SELECT b, SUM(o) AS ct FROM cells GROUP BY 1",
        n="SELECT SUM(o) AS n FROM cells",
        grid="SELECT r.a, c.b, rt * ct / (SELECT n FROM n) AS E, COALESCE(cells.o, 0) AS o"
             " FROM r CROSS JOIN c LEFT JOIN cells ON cells.a = r.a AND cells.b = c.b")


def _chi(spark, sf, col, correction):
    st = stats.chi_square_stat(clean.preprocess(appointments(spark, sf)), col, "NO_SHOW", correction)
    return st.select(F.round("statistic", D).alias("statistic"), "dof", "n")


@query("chi_square_gender", _chi_sql("GENDER", True))
def q_chi_gender(spark, sf):
    return _chi(spark, sf, "GENDER", True)


@query("chi_square_alcoholism", _chi_sql("ALCOHOLISM", True))
def q_chi_alcoholism(spark, sf):
    return _chi(spark, sf, "ALCOHOLISM", True)


@query("chi_square_sms", _chi_sql("SMS_RECEIVED", True))
def q_chi_sms(spark, sf):
    return _chi(spark, sf, "SMS_RECEIVED", True)


@query("chi_square_sms_uncorrected", _chi_sql("SMS_RECEIVED", False))
def q_chi_sms_plain(spark, sf):
    return _chi(spark, sf, "SMS_RECEIVED", False)


@query("chi_square_gender_age", _chi_sql(GENDER_AGE_SQL, True, **_TRAIN))
def q_chi_gender_age(spark, sf):
    """10 x 2 table of the training split: no continuity correction applies (dof > 1)."""
    st = stats.chi_square_stat(_train_ga(spark, sf), "GENDER_AGE", "NO_SHOW")
    return st.select(F.round("statistic", D).alias("statistic"), "dof", "n")


def _expected_sql(a_sql: str, name: str, **rows: str) -> str:
    return with_ctes(f"""
SELECT r.a AS {name}, c.b AS NO_SHOW, CAST(COALESCE(o, 0) AS BIGINT) AS observed, ROUND(rt * ct / (SELECT SUM(o) FROM cells), {D}) AS expected
FROM r CROSS JOIN c LEFT JOIN cells ON cells.a = r.a AND cells.b = c.b""", **rows,
                     cells=f"SELECT {a_sql} AS a, NO_SHOW AS b, COUNT(*) AS o FROM p WHERE {a_sql} IS NOT NULL GROUP BY 1, 2",
                     r="SELECT a, SUM(o) AS rt FROM cells GROUP BY 1", c="SELECT b, SUM(o) AS ct FROM cells GROUP BY 1")


@query("chi_square_expected", _expected_sql(GENDER_AGE_SQL, "GENDER_AGE", **_TRAIN))
def q_chi_expected(spark, sf):
    e = stats.expected_counts(_train_ga(spark, sf), "GENDER_AGE", "NO_SHOW")
    return e.withColumn("expected", F.round("expected", D))


_EMPTY_CELL = "CASE WHEN NO_SHOW = 0 THEN GENDER ELSE 'F' END"


@query("chi_square_expected_empty_cell", _expected_sql(_EMPTY_CELL, "G", p=PREPROCESSED_SQL))
def q_chi_expected_empty(spark, sf):
    """A 2 x 2 table with an empty cell: the cell is in the result, observed 0."""
    df = clean.preprocess(appointments(spark, sf)).select(F.expr(_EMPTY_CELL).alias("G"), "NO_SHOW")
    return stats.expected_counts(df, "G", "NO_SHOW").withColumn("expected", F.round("expected", D))


# The 95 % points of chi-square by degrees of freedom, and of Student's t for large samples.
CRITICAL_CHI2 = {1: 3.841458820694124, 9: 16.918977604620448}
CRITICAL_T = 1.959963984540054


def _decision_sql() -> str:
    tests = [("GENDER", "GENDER", {}), ("ALCOHOLISM", "ALCOHOLISM", {}), ("SMS_RECEIVED", "SMS_RECEIVED", {}),
             ("GENDER_AGE", GENDER_AGE_SQL, _TRAIN)]
    parts = []
    for name, sql, rows in tests:
        parts.append(f"SELECT '{name}' AS variable, dof, n, CASE WHEN statistic > CASE dof WHEN 1 THEN {CRITICAL_CHI2[1]} ELSE {CRITICAL_CHI2[9]} END"
                     f" THEN 'reject independence' ELSE 'cannot reject independence' END AS decision FROM ({_chi_sql(sql, True, **rows)}) t")
    return " UNION ALL ".join(parts)


@query("chi_square_test", _decision_sql())
def q_chi_test(spark, sf):
    """The decision per tested variable, from the p-value of each one-row aggregate."""
    rows = []
    for col in ("GENDER", "ALCOHOLISM", "SMS_RECEIVED", "GENDER_AGE"):
        df = _train_ga(spark, sf) if col == "GENDER_AGE" else clean.preprocess(appointments(spark, sf))
        r = stats.chi_square(df, col, "NO_SHOW")
        rows.append((col, r["dof"], r["n"], r["decision"]))
    return spark.createDataFrame(rows, "variable string, dof long, n long, decision string")


_PB_SQL = with_ctes(f"""
SELECT ROUND(corr(CAST(DAYS_TILL_APPOINTMENT AS DOUBLE), CAST(NO_SHOW AS DOUBLE)), {D}) AS r,
       CAST(COUNT(*) AS BIGINT) AS n,
       ROUND(corr(CAST(DAYS_TILL_APPOINTMENT AS DOUBLE), CAST(NO_SHOW AS DOUBLE))
             * sqrt((COUNT(*) - 2) / (1 - power(corr(CAST(DAYS_TILL_APPOINTMENT AS DOUBLE),
             CAST(NO_SHOW AS DOUBLE)), 2))), 6) AS t
FROM f""", **_TE, f=features_select("train", "te"))


@query("point_biserial", _PB_SQL)
def q_point_biserial(spark, sf):
    train, _, state = _state(spark, sf)
    f = featurize.apply_features(train, state)
    st = stats.point_biserial_stat(f, "DAYS_TILL_APPOINTMENT", "NO_SHOW")
    return st.select(F.round("r", D).alias("r"), "n", F.round("t", 6).alias("t"))


@query("point_biserial_test", f"SELECT r, n, CASE WHEN abs(t) > {CRITICAL_T} THEN 'reject independence'"
                              f" ELSE 'cannot reject independence' END AS decision FROM ({_PB_SQL}) t")
def q_point_biserial_test(spark, sf):
    train, _, state = _state(spark, sf)
    f = featurize.apply_features(train, state)
    r = stats.point_biserial(f, "DAYS_TILL_APPOINTMENT", "NO_SHOW")
    return spark.createDataFrame([(round(float(r["r"]), D), int(r["n"]), stats.decide(r["p_value"]))], "r double, n long, decision string")


def _pairs():
    cols = _FEATURE_COLS
    return [(cols[i], cols[j]) for i in range(len(cols)) for j in range(i + 1, len(cols))]


def _corr_sql(where: str = "") -> str:
    sel = ", ".join(f"CASE WHEN stddev_pop(\"{a}\") * stddev_pop(\"{b}\") > 0 THEN"
                    f" ROUND(corr(CAST(\"{a}\" AS DOUBLE), CAST(\"{b}\" AS DOUBLE)), {D}) + 0.0 END AS \"{a}|{b}\""
                    for a, b in _pairs())
    body = " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, \"{a}|{b}\" AS r FROM w" for a, b in _pairs())
    return with_ctes(f"SELECT * FROM ({body}) u {where}",
                     **_TE, f=features_select("train", "te", digits=15), w=f"SELECT {sel} FROM f")


@query("correlation_matrix", _corr_sql())
def q_correlation_matrix(spark, sf):
    train, _, state = _state(spark, sf)
    f = featurize.apply_features(train, state)
    return stats.correlation_matrix(f, _FEATURE_COLS)


@query("multicollinear_pairs", _corr_sql("WHERE abs(r) > 0.1"))
def q_multicollinear_pairs(spark, sf):
    """Pairs with |r| above 0.1: the original's 0.8 leaves no row on these tables."""
    train, _, state = _state(spark, sf)
    f = featurize.apply_features(train, state)
    return stats.multicollinear_pairs(stats.correlation_matrix(f, _FEATURE_COLS), 0.1)


# ------------------------------------------- a test for each group, p-values in the plan
def _gamma_q_sql(a: str, x: str) -> str:
    """Q(a, x) as one minus the finite sum of the lower function's series."""
    return (f"CASE WHEN {x} <= 0 THEN 1.0 ELSE 1 - exp({a} * ln({x}) - {x} - lgamma({a} + 1)) * list_sum(list_transform(range(400),"
            f" lambda i: exp(i * ln({x}) + lgamma({a} + 1) - lgamma({a} + i + 1)))) END")


def _chi_by_sql(g: str, a: str) -> str:
    return with_ctes(f"""
SELECT g AS {g}, ROUND(statistic, {D}) AS statistic, dof, n, ROUND(p, {D}) AS p_value,
       CASE WHEN p < 0.05 THEN 'reject independence' ELSE 'cannot reject independence' END AS decision
FROM (SELECT *, {_gamma_q_sql('(dof / 2.0)', '(statistic / 2)')} AS p FROM tested)""", p=PREPROCESSED_SQL,
        cells=f"SELECT {g} AS g, {a} AS a, NO_SHOW AS b, COUNT(*) AS o FROM p GROUP BY ALL",
        r="SELECT g, a, SUM(o) AS rt FROM cells GROUP BY ALL", c="SELECT g, b, SUM(o) AS ct FROM cells GROUP BY ALL",
        t="SELECT g, SUM(o) AS n, (COUNT(DISTINCT a) - 1) * (COUNT(DISTINCT b) - 1) AS dof FROM cells GROUP BY g",
        grid="SELECT r.g, rt * ct / n AS E, COALESCE(o, 0) AS o, n, dof FROM r JOIN c USING (g) JOIN t USING (g) LEFT JOIN cells USING (g, a, b)",
        tested="SELECT g, SUM(CASE WHEN dof = 1 THEN power(abs(o - E) - least(0.5, abs(o - E)), 2) / E ELSE power(o - E, 2) / E END) AS statistic,"
               " CAST(MAX(dof) AS BIGINT) AS dof, CAST(MAX(n) AS BIGINT) AS n FROM grid GROUP BY g")


def _chi_by(spark, sf, g, a):
    t = stats.chi_square_by(clean.preprocess(appointments(spark, sf)), g, a)
    return t.withColumns({c: F.round(c, D) for c in ("statistic", "p_value")})


@query("chi_square_by_neighbourhood", _chi_by_sql("NEIGHBOURHOOD", "GENDER"))
def q_chi_by_neighbourhood(spark, sf):
    """Gender against missing an appointment, one corrected 2 x 2 test for each neighbourhood, p-values included."""
    return _chi_by(spark, sf, "NEIGHBOURHOOD", "GENDER")


@query("chi_square_by_gender", _chi_by_sql("GENDER", "NEIGHBOURHOOD"))
def q_chi_by_gender(spark, sf):
    """Neighbourhood against missing an appointment, for each gender: many degrees of freedom."""
    return _chi_by(spark, sf, "GENDER", "NEIGHBOURHOOD")


@query("point_biserial_by_neighbourhood", with_ctes(f"""
SELECT NEIGHBOURHOOD, ROUND(r, {D}) AS r, n, ROUND(t, 6) AS t, ROUND(p, 8) AS p_value,
       CASE WHEN p < 0.05 THEN 'reject independence' ELSE 'cannot reject independence' END AS decision
FROM (SELECT *, CASE WHEN y = 0 THEN 1.0 ELSE 1 - exp(0.5 * ln(y) + h * ln(1 - y) + lgamma(h + 0.5) - lgamma(h) - lgamma(1.5))
      * list_sum(list_transform(range(400), lambda i: exp(i * ln(y) + lgamma(h + 0.5 + i) - lgamma(h + 0.5) + lgamma(1.5) - lgamma(1.5 + i)))) END AS p
      FROM (SELECT *, t * t / (n - 2 + t * t) AS y, (n - 2) / 2.0 AS h FROM
            (SELECT *, r * sqrt((n - 2) / (1 - r * r)) AS t FROM
             (SELECT NEIGHBOURHOOD, corr(CAST(DAYS AS DOUBLE), CAST(NO_SHOW AS DOUBLE)) AS r, COUNT(*) AS n FROM x GROUP BY 1))))""",
    p=PREPROCESSED_SQL, x=f"SELECT *, {DAYS_TILL_SQL} AS DAYS FROM p"))
def q_point_biserial_by(spark, sf):
    """Waiting days against missing an appointment, one test for each neighbourhood."""
    p = clean.preprocess(appointments(spark, sf)).withColumn("DAYS", days_till_appointment())
    t = stats.point_biserial_by(p, "NEIGHBOURHOOD", "DAYS")
    return t.withColumns({"r": F.round("r", D), "t": F.round("t", 6), "p_value": F.round("p_value", 8)})


_CERTIFIED = ["AGE", "SCHOLARSHIP", "HYPERTENSION", "DIABETES", "ALCOHOLISM", "HANDICAP", "SMS_RECEIVED", "DAYS"]


@query("logistic_certificate", "SELECT unnest(" + str([*_CERTIFIED, "(intercept)"]) + ") AS Feature, 1 AS gradient_ok, 1 AS agrees,"
       " 1 AS other_ok, (SELECT CAST(COUNT(*) AS BIGINT) FROM (" + with_ctes(
           "SELECT * FROM sp WHERE split = 'train'", p=PREPROCESSED_SQL, **split_ctes("p", "sp")) + ")) AS n_rows")
def q_logistic_certificate(spark, sf):
    """Balanced logistic regression by Newton steps, with the proof of its optimum: per feature, that the penalised
    gradient at the fit is below 1e-6, that the fit agrees with MLlib's to 1e-4, and MLlib's own gradient (below 1e-4)."""
    train = sampling.split_frames(clean.preprocess(appointments(spark, sf)))[0].withColumn("DAYS", days_till_appointment())
    train = materialize(encode.fit_scaling(train, ["AGE", "DAYS"]).transform(train).select("NO_SHOW", *_CERTIFIED), "certified")
    weights = {float(k): v for k, v in models.class_weights(train)["class_weight"].items()}
    weight = F.when(F.col("NO_SHOW") == 1, weights[1.0]).otherwise(weights[0.0])
    n = train.count()
    own = newton.fit(train, _CERTIFIED, "NO_SHOW", weight, 1.0 / n)
    other = models.fit_logistic(models.model_frame(train, _CERTIFIED, "NO_SHOW", weights), n=n)
    theirs = [*map(float, other.coefficients.toArray()), float(other.intercept)]
    gradient = newton.certificate(newton.design(train, _CERTIFIED, "NO_SHOW", weight), other.coefficients.toArray(), other.intercept, 1.0 / n)
    rows = [(f, int(abs(g) < 1e-6), int(abs(a - b) < 1e-4), int(abs(h) < 1e-4), n) for f, a, g, b, h in zip(
        [*_CERTIFIED, "(intercept)"], [*own.coefficients, own.intercept], own.gradient, theirs, gradient, strict=True)]
    return spark.createDataFrame(rows, "Feature string, gradient_ok int, agrees int, other_ok int, n_rows long")
