"""Chi-square and point-biserial with known answers."""

import math

import pytest

from truant.operators import stats


def _table(spark, counts):
    rows = []
    for (a, b), n in counts.items():
        rows += [(a, b)] * n
    return spark.createDataFrame(rows, "a string, NO_SHOW int")


def test_chi_square_2x2_with_and_without_yates(spark):
    df = _table(spark, {("x", 0): 30, ("x", 1): 10, ("y", 0): 20, ("y", 1): 20})
    plain = stats.chi_square(df, "a", "NO_SHOW", correction=False)
    assert plain["statistic"] == pytest.approx(5.333333, abs=1e-6) and plain["dof"] == 1
    assert plain["p_value"] == pytest.approx(0.0209213, abs=1e-7)
    yates = stats.chi_square(df, "a", "NO_SHOW", correction=True)
    assert yates["statistic"] == pytest.approx(4.32, abs=1e-9)
    assert yates["p_value"] == pytest.approx(0.0376669, abs=1e-7)


def test_chi_square_with_empty_cell(spark):
    # a zero cell is never materialised; the identity still gives the textbook value
    counts = {("x", 0): 5, ("y", 0): 3, ("y", 1): 4, ("z", 1): 6}
    df = _table(spark, counts)
    r = stats.chi_square(df, "a", "NO_SHOW", correction=False)
    n, R, C = 18, {"x": 5, "y": 7, "z": 6}, {0: 8, 1: 10}
    exp = sum((counts.get((a, b), 0) - R[a] * C[b] / n) ** 2 / (R[a] * C[b] / n) for a in R for b in C)
    assert r["statistic"] == pytest.approx(exp) and r["dof"] == 2


def test_chi2_sf_even_and_odd():
    assert stats.chi2_sf(2.0, 2) == pytest.approx(math.exp(-1.0))
    assert stats.chi2_sf(3.84145882, 1) == pytest.approx(0.05, abs=1e-8)
    assert stats.chi2_sf(7.81472790, 3) == pytest.approx(0.05, abs=1e-8)


def test_t_p_value():
    # two-sided p of t = 2.228138852 with 10 dof is 0.05
    assert stats.t_two_sided_p(2.228138852, 10) == pytest.approx(0.05, abs=1e-8)


def test_point_biserial(spark):
    rows = [(1.0, 0), (2.0, 0), (3.0, 1), (4.0, 1), (2.5, 0), (3.5, 1)]
    df = spark.createDataFrame(rows, "x double, NO_SHOW int")
    r = stats.point_biserial(df, "x")
    xs, ys = [a for a, _ in rows], [b for _, b in rows]
    mx, my = sum(xs) / 6, sum(ys) / 6
    cov = sum((a - mx) * (b - my) for a, b in rows)
    rr = cov / math.sqrt(sum((a - mx) ** 2 for a in xs) * sum((b - my) ** 2 for b in ys))
    assert r["r"] == pytest.approx(rr)
    assert r["t"] == pytest.approx(rr * math.sqrt(4 / (1 - rr * rr)))


def test_correlation_constant_column_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0, 7.0), (2.0, 4.1, 7.0), (3.0, 5.9, 7.0)], "a double, b double, c double")
    for method in ("gram", "pairwise"):
        got = {(r.a, r.b): r.r for r in stats.correlation_matrix(df, ["a", "b", "c"], method=method).collect()}
        assert got[("a", "c")] is None and got[("a", "b")] > 0.99


def test_one_row_or_column_is_no_dependence(spark):
    r = stats.chi_square(_table(spark, {("x", 0): 5, ("x", 1): 3}), "a", "NO_SHOW")
    assert (r["dof"], r["p_value"], r["reject"], r["decision"]) == (0, 1.0, False, "cannot reject independence")


def test_expected_counts_have_all_cells(spark):
    got = {(r.a, r.NO_SHOW): (r.observed, r.expected) for r in stats.expected_counts(_table(spark, {("x", 0): 6, ("y", 0): 2, ("y", 1): 4}), "a").collect()}
    assert got == {("x", 0): (6, 4.0), ("x", 1): (0, 2.0), ("y", 0): (2, 4.0), ("y", 1): (4, 2.0)}


def test_decision():
    assert stats.decide(0.01) == "reject independence" and stats.decide(0.2) == "cannot reject independence"
