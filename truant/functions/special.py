"""Special functions as column expressions, for p-values of whole tables of tests.

Everything is a finite fold over a fixed sequence, evaluated row by row in the
plan: no Python, no driver loop.  Arguments are doubles; a null gives a null.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Terms of the series and levels of the continued fractions.
TERMS = 400
TINY = 1e-300

# Lanczos' coefficients for g = 7.
LANCZOS_G = 7.0
LANCZOS = [0.99999999999980993, 676.5203681218851, -1259.1392167224028, 771.32342877765313, -176.61502916214059,
           12.507343278686905, -0.13857109526572012, 9.9843695780195716e-6, 1.5056327351493116e-7]


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c if isinstance(c, Column) else F.lit(float(c))


def log_gamma(x) -> Column:
    """ln of the gamma function for x > 0."""
    x = _col(x).cast("double") - 1.0
    total = F.lit(LANCZOS[0])
    for i, c in enumerate(LANCZOS[1:], 1):
        total = total + F.lit(c) / (x + float(i))
    t = x + LANCZOS_G + 0.5
    return F.lit(0.5 * math.log(2 * math.pi)) + (x + 0.5) * F.ln(t) - t + F.ln(total)


def _let(value: Column, body) -> Column:
    return F.transform(F.array(value), body)[0]


def _away_from_zero(x: Column) -> Column:
    return F.when(F.abs(x) < TINY, F.lit(TINY)).otherwise(x)


def _levels() -> Column:
    return F.sequence(F.lit(1), F.lit(TERMS))


def _gamma_series(a: Column, x: Column) -> Column:
    """P(a, x) = x^a e^-x / gamma(a + 1) * (1 + x / (a + 1) + x^2 / ((a + 1)(a + 2)) + ...)."""
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total"))

    def step(s: Column, n: Column) -> Column:
        return _let(s["term"] * x / (a + n), lambda t: F.struct(t.alias("term"), (s["total"] + t).alias("total")))

    return F.aggregate(_levels(), start, step, lambda s: s["total"] * F.exp(a * F.ln(x) - x - log_gamma(a + 1.0)))


def _gamma_fraction(a: Column, x: Column) -> Column:
    """Q(a, x) as a continued fraction, by Lentz's method."""
    b0 = x + 1.0 - a
    start = F.struct(F.lit(1 / TINY).alias("c"), (1.0 / _away_from_zero(b0)).alias("d"), (1.0 / _away_from_zero(b0)).alias("h"))

    def step(s: Column, n: Column) -> Column:
        an, b = -n * (n - a), b0 + 2.0 * n
        d, c = 1.0 / _away_from_zero(b + an * s["d"]), _away_from_zero(b + an / s["c"])
        return _let(F.struct(d.alias("d"), c.alias("c")), lambda t: F.struct(t["c"].alias("c"), t["d"].alias("d"), (s["h"] * t["c"] * t["d"]).alias("h")))

    return F.aggregate(_levels(), start, step, lambda s: s["h"] * F.exp(a * F.ln(x) - x - log_gamma(a)))


def gamma_q(a, x) -> Column:
    """The upper regularised incomplete gamma function Q(a, x), a > 0."""
    a, x = _col(a).cast("double"), _col(x).cast("double")
    return F.when(x <= 0, F.when(x.isNotNull() & a.isNotNull(), F.lit(1.0))).when(x < a + 1.0, 1.0 - _gamma_series(a, x)).otherwise(_gamma_fraction(a, x))


def chi_square_p(statistic, dof) -> Column:
    """P(chi-square with ``dof`` degrees of freedom >= statistic); null without degrees of freedom."""
    dof = _col(dof).cast("double")
    return F.when(dof > 0, gamma_q(dof / 2.0, _col(statistic) / 2.0))


def _beta_fraction(a: Column, b: Column, x: Column) -> Column:
    first = 1.0 / _away_from_zero(1.0 - (a + b) * x / (a + 1.0))
    start = F.struct(F.lit(1.0).alias("c"), first.alias("d"), first.alias("h"))

    def half(s: Column, term: Column) -> Column:
        d, c = 1.0 / _away_from_zero(1.0 + term * s["d"]), _away_from_zero(1.0 + term / s["c"])
        return _let(F.struct(d.alias("d"), c.alias("c")), lambda t: F.struct(t["c"].alias("c"), t["d"].alias("d"), (s["h"] * t["c"] * t["d"]).alias("h")))

    def step(s: Column, n: Column) -> Column:
        m = n.cast("double")
        even = m * (b - m) * x / ((a + 2.0 * m - 1.0) * (a + 2.0 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2.0 * m) * (a + 2.0 * m + 1.0))
        return _let(half(s, even), lambda t: half(t, odd))

    front = F.exp(log_gamma(a + b) - log_gamma(a) - log_gamma(b) + a * F.ln(x) + b * F.ln(1.0 - x))
    return F.aggregate(_levels(), start, step, lambda s: s["h"]) * front / a


def beta_i(a, b, x) -> Column:
    """The regularised incomplete beta function I_x(a, b), a, b > 0."""
    a, b, x = (_col(c).cast("double") for c in (a, b, x))
    known = a.isNotNull() & b.isNotNull()
    return (F.when(x <= 0, F.when(known, F.lit(0.0))).when(x >= 1, F.when(known, F.lit(1.0)))
            .when(x < (a + 1.0) / (a + b + 2.0), _beta_fraction(a, b, x)).otherwise(1.0 - _beta_fraction(b, a, 1.0 - x)))


def student_t_p(t, dof) -> Column:
    """Two-sided p-value of a t statistic; null without degrees of freedom."""
    t, dof = _col(t).cast("double"), _col(dof).cast("double")
    return F.when(dof > 0, beta_i(dof / 2.0, 0.5, dof / (dof + t * t)))
