"""Newton's logistic regression with its certificate, and p-values as columns."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from truant.functions import special
from truant.operators import models, newton, stats


def frame(spark, n=500, d=4, seed=1, parts=5):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)) * np.arange(1, d + 1)
    p = 1 / (1 + np.exp(-(x @ np.linspace(-1, 1, d) + 0.3)))
    y = (rng.random(n) < p).astype(int)
    rows = [(*r, int(t)) for r, t in zip(x.tolist(), y, strict=True)]
    names = [f"f{i}" for i in range(d)]
    return spark.createDataFrame(rows, ", ".join(f"{c} double" for c in names) + ", NO_SHOW int").repartition(parts), names


def test_gradient_is_zero_and_the_fit_is_mllibs(spark):
    df, names = frame(spark)
    fit = newton.fit(df, names, "NO_SHOW", penalty=1 / 500)
    assert np.abs(fit.gradient).max() < 1e-9 and fit.steps < 15
    other = models.fit_logistic(models.model_frame(df, names, "NO_SHOW"), weighted=False, n=500)
    assert np.allclose(fit.coefficients, other.coefficients.toArray(), atol=1e-4)
    assert fit.intercept == pytest.approx(other.intercept, abs=1e-4)
    assert [r.Feature for r in fit.frame(spark).collect()] == [*names, "(intercept)"]


def test_gradient_equals_finite_differences(spark):
    df, names = frame(spark, 80, 3)
    w = F.when(F.col("NO_SHOW") == 1, 2.5).otherwise(0.5)
    rows = newton.design(df, names, "NO_SHOW", w)
    beta = np.array([0.3, -0.2, 0.1, 0.7])
    _, g, h = newton._at(rows, beta, 0.05)
    for i in range(4):
        e = np.zeros(4)
        e[i] = 1e-5
        up, down = newton._at(rows, beta + e, 0.05), newton._at(rows, beta - e, 0.05)
        assert g[i] == pytest.approx((up[0] - down[0]) / 2e-5, abs=1e-7)
        assert h[i] == pytest.approx((up[1] - down[1]) / 2e-5, abs=1e-6)
    assert np.allclose(newton.certificate(rows, beta[:-1], beta[-1], 0.05), g)


def test_weights_are_repeated_rows(spark):
    df, names = frame(spark, 60, 2)
    twice = df.union(df.where("NO_SHOW = 1"))
    a = newton.fit(df, names, "NO_SHOW", F.when(F.col("NO_SHOW") == 1, 2.0).otherwise(1.0), 0.01)
    b = newton.fit(twice, names, "NO_SHOW", penalty=0.01)
    assert np.allclose(a.coefficients, b.coefficients, atol=1e-8)


def test_dependent_features_nulls_and_separation(spark):
    df, names = frame(spark, 120, 2)
    df = df.withColumn("copy", F.col("f0")).withColumn("nothing", F.lit(None).cast("double"))
    rows = df.union(df.limit(1).withColumn("NO_SHOW", F.lit(None).cast("int")))  # a row without a target is left out
    fit = newton.fit(rows, [*names, "copy", "nothing"], "NO_SHOW", penalty=0.01)
    assert np.abs(fit.gradient).max() < 1e-9
    assert fit.coefficients[0] == pytest.approx(fit.coefficients[2]) and fit.coefficients[3] == 0
    apart = spark.createDataFrame([(float(i), int(i > 0)) for i in range(-5, 6)], "a double, NO_SHOW int")
    assert np.abs(newton.fit(apart, ["a"], "NO_SHOW", penalty=0.1).gradient).max() < 1e-9
    assert newton.fit(apart, ["a"], "NO_SHOW", penalty=0.0, max_steps=12).steps <= 12


# --------------------------------------------------------------- special
def column(spark, f, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(f).collect()]


def test_log_gamma(spark):
    x = [0.5, 1.0, 1.5, 2.0, 10.0, 170.3, 1e6]
    got = column(spark, special.log_gamma("x"), [(v,) for v in x], "x double")
    assert got == pytest.approx([math.lgamma(v) for v in x], rel=1e-13, abs=1e-13)


def test_chi_square_p(spark):
    rows = [(s, d) for s in (0.0, 1e-8, 0.3, 3.84, 9.0, 30.0, 200.0) for d in (1, 2, 3, 9, 24, 101)]
    got = column(spark, special.chi_square_p("s", "d"), rows, "s double, d int")
    assert got == pytest.approx([stats.chi2_sf(s, d) for s, d in rows], rel=1e-9, abs=1e-14)
    assert column(spark, special.chi_square_p("s", "d"), [(None, 1), (1.0, 0), (1.0, None)], "s double, d int") == [None] * 3


def test_student_t_p(spark):
    rows = [(t, n) for t in (-4.0, -0.1, 0.0, 0.5, 1.96, 8.0) for n in (1, 2, 5, 30, 1000, 100_000)]
    got = column(spark, special.student_t_p("t", "n"), rows, "t double, n int")
    assert got == pytest.approx([stats.t_two_sided_p(t, n) for t, n in rows], rel=1e-9, abs=1e-13)
    assert column(spark, special.student_t_p("t", "n"), [(None, 5), (1.0, 0)], "t double, n int") == [None, None]


def test_tests_by_group_are_the_single_ones(spark):
    rng = np.random.default_rng(5)
    rows = [(g, str(rng.integers(0, 2 + i)), int(rng.integers(0, 2)), float(rng.normal())) for i, g in enumerate(["x", "y", None]) for _ in range(60)]
    rows += [("one", "0", 0, 1.0), ("one", "0", 1, 1.0), ("z", None, 1, None), ("skip", None, 1, None)]
    df = spark.createDataFrame(rows, "g string, a string, NO_SHOW int, v double")
    got = {r.g: r for r in stats.chi_square_by(df, "g", "a").collect()}
    t = {r.g: r for r in stats.point_biserial_by(df, "g", "v").collect()}
    for g in ("x", "y", None):
        own = df.where(F.col("g").eqNullSafe(F.lit(g)))
        one, two = stats.chi_square(own, "a"), stats.point_biserial(own, "v")
        assert (got[g].dof, got[g].n, got[g].decision) == (one["dof"], one["n"], one["decision"])
        assert (got[g].statistic, got[g].p_value) == pytest.approx((one["statistic"], one["p_value"]), rel=1e-9)
        assert (t[g].r, t[g].p_value) == pytest.approx((two["r"], two["p_value"]), rel=1e-9)
    assert got["one"].dof == 0 and got["one"].p_value == 1.0 and t["one"].p_value is None and "skip" not in got
    plan = stats.chi_square_by(df, "g", "a")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
