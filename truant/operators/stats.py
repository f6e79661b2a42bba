"""Statistical tests as aggregates; p-values from closed forms on the one-row
result (no SciPy).  Contingency work never builds the full cell grid: the
chi-square statistic is written in terms of observed cells and margins."""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from truant.functions.special import chi_square_p, student_t_p
from truant.schema import TARGET
from truant.session import materialize


# ------------------------------------------------------------ distributions
def chi2_sf(x: float, dof: int) -> float:
    """Survival function of chi-square with integer ``dof``."""
    if dof <= 0:  # one row or one column: nothing can depend
        return 1.0
    if x is None:
        return float("nan")
    if x <= 0:
        return 1.0
    h = x / 2.0
    if dof % 2 == 0:
        term, s = 1.0, 1.0
        for i in range(1, dof // 2):
            term *= h / i
            s += term
        return math.exp(-h) * s
    r = math.sqrt(x)
    s = math.erfc(r / math.sqrt(2.0))
    term = math.sqrt(2.0 * x / math.pi) * math.exp(-h)
    acc = 0.0
    for i in range(1, (dof - 1) // 2 + 1):
        acc += term
        term *= x / (2 * i + 1)
    return min(1.0, s + acc)


def _betacf(a: float, b: float, x: float) -> float:
    tiny, qab, qap, qam = 1e-300, a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 - qab * x / qap
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 10_000):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        de = d * c
        h *= de
        if abs(de - 1.0) < 1e-15:
            break
    return h


def betainc(a: float, b: float, x: float) -> float:
    """Regularized incomplete beta I_x(a, b) (continued fraction)."""
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    lbt = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    if x < (a + 1.0) / (a + b + 2.0):
        return math.exp(lbt) * _betacf(a, b, x) / a
    return 1.0 - math.exp(lbt) * _betacf(b, a, 1.0 - x) / b


def t_two_sided_p(t: float, df: float) -> float:
    if t is None or df <= 0 or math.isnan(t):
        return float("nan")
    if math.isinf(t):
        return 0.0
    return betainc(df / 2.0, 0.5, df / (df + t * t))


# ------------------------------------------------------------- chi-square
def contingency(df: DataFrame, a: str, b: str = TARGET) -> DataFrame:
    return df.groupBy(a, b).agg(F.count(F.lit(1)).alias("observed"))


def chi_square_stat(df: DataFrame, a: str, b: str = TARGET, correction: bool = True) -> DataFrame:
    """One row: statistic, dof, n (rows with both values non-null).

    Without correction: sum over observed cells of O^2/E, minus n (cells with
    O = 0 contribute E - 2*0 + 0 and cancel in the identity).  A 2 x 2 table
    with ``correction`` gets Yates' continuity correction: |O - E| is equal on
    all four cells, so the statistic is (d - min(0.5, d))^2 * n * sum(1/R) * sum(1/C).
    """
    base = df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    cells = materialize(contingency(base, a, b), "contingency")
    rows = cells.groupBy(a).agg(F.sum("observed").alias("R"))
    cols = cells.groupBy(b).agg(F.sum("observed").alias("C"))
    # margins summarised to scalars (one row each) and used as literals
    rt = rows.agg(F.count(F.lit(1)).alias("r"), F.sum("R").alias("n"),
                  F.sum(1.0 / F.col("R")).alias("inv_r")).first()
    ct = cols.agg(F.count(F.lit(1)).alias("c"), F.sum(1.0 / F.col("C")).alias("inv_c")).first()
    n = float(rt["n"] or 0)
    dof = (int(rt["r"]) - 1) * (int(ct["c"]) - 1)
    e = (cells.join(rows, a).join(cols, b)
              .withColumn("E", F.col("R") * F.col("C") / F.lit(n or 1.0)))
    obs = e.agg(F.sum(F.col("observed") * F.col("observed") / F.col("E")).alias("s_o2e"),
                F.max(F.abs(F.col("observed") - F.col("E"))).alias("d"))
    if correction and dof == 1:
        d = F.col("d")
        stat = F.pow(d - F.least(F.lit(0.5), d), 2) * F.lit(n * (rt["inv_r"] or 0) * (ct["inv_c"] or 0))
    else:
        stat = F.col("s_o2e") - F.lit(n)
    return obs.select(stat.alias("statistic"), F.lit(dof).cast("long").alias("dof"),
                      F.lit(int(n)).cast("long").alias("n"))


MAX_CELLS = 10_000_000


def expected_counts(df: DataFrame, a: str, b: str = TARGET) -> DataFrame:
    """Observed and expected count of every cell, cells without a row included.

    Each row margin is exploded over the column margins (the classes, a short
    list from a small aggregate); MAX_CELLS bounds the table.
    """
    base = df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    cells = materialize(contingency(base, a, b), "contingency")
    rows = cells.groupBy(a).agg(F.sum("observed").alias("R"))
    cols = cells.groupBy(b).agg(F.sum("observed").alias("C")).limit(MAX_CELLS + 1).collect()
    n_rows = rows.count()
    if n_rows * len(cols) > MAX_CELLS:
        raise ValueError(f"more than {MAX_CELLS} cells")
    if not cols:
        return cells.select(a, b, "observed", F.lit(0.0).alias("expected"))
    n = float(sum(m["C"] for m in cols))
    kind = dict(cells.dtypes)[b]
    margins = F.array(*[F.struct(F.lit(m[b]).cast(kind).alias(b), F.lit(m["C"]).alias("C")) for m in cols])
    grid = rows.withColumn("m", F.explode(margins))
    grid = grid.select(a, F.col(f"m.{b}").alias(b), (F.col("R") * F.col("m.C") / F.lit(n)).alias("expected"))
    return grid.join(cells, [a, b], "left").select(a, b, F.coalesce("observed", F.lit(0)).alias("observed"), "expected")


def chi_square(df: DataFrame, a: str, b: str = TARGET, correction: bool = True,
               alpha: float = 0.05) -> dict:
    """Statistic, dof, p-value and decision (the p-value is computed on the
    one-row aggregate on the driver)."""
    r = chi_square_stat(df, a, b, correction).first()
    p = chi2_sf(r["statistic"], int(r["dof"]))
    return {"variable": a, "statistic": r["statistic"], "dof": int(r["dof"]), "n": int(r["n"]),
            "p_value": p, "reject": bool(p < alpha), "decision": decide(p, alpha)}


def decide(p_value: float, alpha: float = 0.05) -> str:
    return "reject independence" if p_value < alpha else "cannot reject independence"


# -------------------------------------------------------- point-biserial
def point_biserial_stat(df: DataFrame, x: str, y: str = TARGET) -> DataFrame:
    """One row: r (Pearson of x with a 0/1 y), n, and t = r*sqrt((n-2)/(1-r^2))."""
    base = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    agg = base.agg(pearson(x, y).alias("r"),
                   F.count(F.lit(1)).alias("n"))
    t = F.col("r") * F.sqrt(F.try_divide(F.col("n") - 2, 1 - F.col("r") * F.col("r")))
    return agg.select("r", F.col("n").cast("long").alias("n"), t.alias("t"))


def point_biserial(df: DataFrame, x: str, y: str = TARGET, alpha: float = 0.05) -> dict:
    r = point_biserial_stat(df, x, y).first()
    p = t_two_sided_p(r["t"], r["n"] - 2) if r["t"] is not None else float("nan")
    return {"r": r["r"], "n": r["n"], "t": r["t"], "p_value": p, "reject": bool(p < alpha)}


# ------------------------------------------------- one test for each group
def chi_square_by(df: DataFrame, group: str, a: str, b: str = TARGET, correction: bool = True, alpha: float = 0.05) -> DataFrame:
    """(group, statistic, dof, n, p_value, decision): the test of ``a`` against ``b`` within every group.

    One shuffle by (group, a, b) and windows over the counted cells; p-values
    are column expressions, so the groups may be any number."""
    cells = df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(group, a, b).agg(F.count(F.lit(1)).alias("o"))
    total = lambda *keys: F.sum("o").over(Window.partitionBy(*keys))
    cells = cells.select(group, a, b, "o", total(group, a).alias("r"), total(group, b).alias("c"), total(group).alias("n"))
    e = F.col("r") * F.col("c") / F.col("n")
    # an inverse margin is split among its cells, so that each margin counts once
    per_row, per_col = (F.sum(1.0 / F.col(x) * F.col("o") / F.col(x)) for x in ("r", "c"))
    s = cells.groupBy(group).agg(F.sum(F.col("o") * F.col("o") / e).alias("o2e"), F.max(F.abs(F.col("o") - e)).alias("d"), F.max("n").alias("n"),
                                 per_row.alias("inv_r"), per_col.alias("inv_c"), F.count_distinct(a).alias("ra"), F.count_distinct(b).alias("cb"))
    dof = ((F.col("ra") - 1) * (F.col("cb") - 1)).cast("long")
    yates = F.pow(F.col("d") - F.least(F.lit(0.5), F.col("d")), 2) * F.col("n") * F.col("inv_r") * F.col("inv_c")
    plain = F.greatest(F.lit(0.0), F.col("o2e") - F.col("n"))
    out = s.select(group, (F.when(dof == 1, yates).otherwise(plain) if correction else plain).alias("statistic"), dof.alias("dof"), F.col("n").cast("long").alias("n"))
    out = out.withColumn("p_value", F.when(F.col("dof") > 0, chi_square_p("statistic", "dof")).otherwise(F.lit(1.0)))
    return out.withColumn("decision", decide_col("p_value", alpha))


def point_biserial_by(df: DataFrame, group: str, x: str, y: str = TARGET, alpha: float = 0.05) -> DataFrame:
    """(group, r, n, t, p_value, decision) of a number ``x`` against a 0/1 ``y`` within every group; null where nothing varies."""
    base = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    out = base.groupBy(group).agg(pearson(x, y).alias("r"), F.count(F.lit(1)).cast("long").alias("n"))
    out = out.withColumn("t", F.when(F.col("n") > 2, F.col("r") * F.sqrt(F.try_divide(F.col("n") - 2, 1 - F.col("r") * F.col("r")))))
    return out.withColumn("p_value", student_t_p("t", F.col("n") - 2)).withColumn("decision", decide_col("p_value", alpha))


def decide_col(p_value: str, alpha: float = 0.05):
    return F.when(F.col(p_value) < alpha, "reject independence").when(F.col(p_value).isNotNull(), "cannot reject independence")


# ------------------------------------------------------------ correlation
def pearson(a: str, b: str):
    """Pearson r over rows where both are non-null; null (not an error under
    ANSI mode) when either side has zero variance."""
    x = F.when(F.col(b).isNotNull(), F.col(a).cast("double"))
    y = F.when(F.col(a).isNotNull(), F.col(b).cast("double"))
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def correlation_matrix(df: DataFrame, cols: list[str], digits: int = 9, method: str = "auto") -> DataFrame:
    """Long form (a, b, r) for every pair of ``cols``; zero variance -> null.

    ``auto``: one cheap pass counts nulls; without nulls the whole matrix
    comes from MLlib's ``Correlation`` (a single tree aggregation of the
    Gram matrix over a vector column, p x p on the driver).  With nulls each
    pair is computed pairwise-complete, like pandas, in one (wider) pass.
    """
    pairs = list(combinations(cols, 2))
    spark = df.sparkSession
    if not pairs:
        return spark.createDataFrame([], "a string, b string, r double")
    if method == "auto":
        nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols]).first()
        method = "gram" if all((nulls[c] or 0) == 0 for c in cols) else "pairwise"
    if method == "gram":
        from pyspark.ml.feature import VectorAssembler
        from pyspark.ml.stat import Correlation
        v = VectorAssembler(inputCols=cols, outputCol="__v").transform(
            df.select(*[F.col(c).cast("double").alias(c) for c in cols]))
        m = Correlation.corr(v, "__v", "pearson").first()[0].toArray()
        rows = []
        for a, b in pairs:
            r = float(m[cols.index(a), cols.index(b)])
            rows.append((a, b, None if math.isnan(r) else round(r, digits) + 0.0))
        return spark.createDataFrame(rows, "a string, b string, r double")
    wide = df.agg(*[pearson(a, b).alias(f"{i}") for i, (a, b) in enumerate(pairs)])
    structs = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"),
                        (F.round(F.col(f"{i}"), digits) + 0.0).alias("r")) for i, (a, b) in enumerate(pairs)]
    return wide.select(F.explode(F.array(*structs)).alias("x")).select("x.*")


def multicollinear_pairs(corr: DataFrame, threshold: float = 0.8) -> DataFrame:
    return corr.where(F.abs(F.col("r")) > threshold)
