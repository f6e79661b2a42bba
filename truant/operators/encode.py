"""Encoders and scaling as fit (small aggregate) + transform (projection or
broadcast lookup).  Fitted state is plain data so it can be saved and
applied unchanged to later batches and streams."""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from truant.plans.joins import broadcast_if_small
from truant.plans.prefix import running_totals
from truant.schema import TARGET
from truant.session import materialize

MAX_CATEGORIES = 10_000


# ------------------------------------------------------------------ one-hot
def fit_categories(df: DataFrame, col: str, max_categories: int = MAX_CATEGORIES) -> list[str]:
    """Sorted distinct non-null values (one small aggregate).

    Refuses columns with more than ``max_categories`` values: each category
    becomes a column.  :func:`one_hot_long` is the form for more values.
    """
    vals = (df.select(col).where(F.col(col).isNotNull()).distinct()
              .limit(max_categories + 1).collect())
    if len(vals) > max_categories:
        raise ValueError(f"{col} has more than {max_categories} categories")
    return sorted(str(r[0]) for r in vals)


def one_hot(df: DataFrame, col: str, categories: list[str], drop_first: bool = True,
            prefix: str | None = None) -> DataFrame:
    """One int column per frozen category (the first dropped), source dropped.

    Unknown and null values give an all-zero row; the columns do not depend on
    the values present in this frame.
    """
    prefix = prefix or col
    keep = categories[1:] if drop_first else categories
    others = [c for c in df.columns if c != col]
    dummies = [F.when(F.col(col) == F.lit(c), 1).otherwise(0).cast("int").alias(f"{prefix}_{c}")
               for c in keep]
    return df.select(*others, *dummies)


def category_index(df: DataFrame, col: str) -> DataFrame:
    """(value, index): the distinct non-null values as text, numbered from 0 in their order; any number of them."""
    values = materialize(df.select(F.col(col).cast("string").alias("value")).where("value is not null").distinct().withColumn("one", F.lit(1)), "categories")
    return running_totals(values, "value", ["one"], values.count()).select("value", (F.col("cum_one") - 1).cast("long").alias("index"))


def one_hot_long(df: DataFrame, key: str, col: str, index: DataFrame, drop_first: bool = True) -> DataFrame:
    """(key, index): where the one-hot row of ``key`` has its 1, for columns of any number of values.

    ``index`` is the frozen table of :func:`category_index`.  A null, unknown
    or dropped value has no row, as it has no 1 in the wide form."""
    rows = df.select(key, F.col(col).cast("string").alias("value"))
    kept = index.where("index > 0") if drop_first else index
    return rows.join(broadcast_if_small(kept), "value").select(key, (F.col("index") - int(drop_first)).alias("index"))


# ---------------------------------------------------------- target encoding
@dataclass
class TargetEncoding:
    """Fitted category -> value table plus the prior for unseen values."""
    column: str
    prior: float
    table: DataFrame            # column, n, mean, value
    n_categories: int
    params: dict = field(default_factory=dict)

    def transform(self, df: DataFrame, out: str | None = None) -> DataFrame:
        out = out or self.column
        lut = broadcast_if_small(self.table.select(F.col(self.column).alias("__cat"),
                                                   F.col("value").alias("__te")),
                                 self.n_categories)
        j = df.join(lut, df[self.column] == lut["__cat"], "left")
        enc = F.coalesce(F.col("__te"), F.lit(self.prior)).alias(out)
        cols = [enc if c == self.column else F.col(c) for c in df.columns]
        if out != self.column:
            cols.append(enc)
        return j.select(*cols)


def _fit_stats(df: DataFrame, col: str, target: str) -> tuple[DataFrame, float, int]:
    stats = materialize(df.where(F.col(target).isNotNull())
                          .groupBy(col).agg(F.count(F.lit(1)).alias("n"),
                                            F.sum(F.col(target).cast("double")).alias("s")), "category-stats")
    tot = stats.agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.count(F.lit(1)).alias("k")).first()
    prior = (tot["s"] / tot["n"]) if tot["n"] else 0.0
    return stats, prior, int(tot["k"] or 0)


def fit_target_encoding(df: DataFrame, col: str, target: str = TARGET,
                        min_samples_leaf: float = 20.0, smoothing: float = 10.0,
                        single_to_prior: bool = True) -> TargetEncoding:
    """Sigmoid shrinkage toward the prior (Micci-Barreca 2001):

    ``lam = 1 / (1 + exp(-(n - min_samples_leaf) / smoothing))``,
    ``value = lam * mean + (1 - lam) * prior``; a category seen once gets the
    prior.  One grouped aggregate; the prior comes from the same table.
    """
    stats, prior, _ = _fit_stats(df, col, target)
    return target_encoding_from_stats(stats, col, prior, min_samples_leaf, smoothing, single_to_prior)


def target_encoding_from_stats(stats: DataFrame, col: str, prior: float, min_samples_leaf: float = 20.0,
                               smoothing: float = 10.0, single_to_prior: bool = True) -> TargetEncoding:
    """Encoding table from per-category (n, s = sum of target).  The table
    stays a DataFrame, written once; only its row count reaches the driver."""
    lam = 1.0 / (1.0 + F.exp(-(F.col("n") - F.lit(min_samples_leaf)) / F.lit(smoothing)))
    mean = F.col("s") / F.col("n")
    value = lam * mean + (1.0 - lam) * F.lit(prior)
    if single_to_prior:
        value = F.when(F.col("n") == 1, F.lit(prior)).otherwise(value)
    table = materialize(stats.select(col, F.col("n").cast("long").alias("n"), mean.alias("mean"), value.alias("value")), "encoding")
    k = table.count()
    return TargetEncoding(col, prior, table, k, {"min_samples_leaf": min_samples_leaf,
                                                 "smoothing": smoothing, "kind": "sigmoid"})


def fit_target_encoding_m(df: DataFrame, col: str, target: str = TARGET,
                          m: float = 10.0) -> TargetEncoding:
    """m-estimate variant: ``(n * mean + m * prior) / (n + m)``."""
    stats, prior, k = _fit_stats(df, col, target)
    value = (F.col("s") + F.lit(m * prior)) / (F.col("n") + F.lit(m))
    table = stats.select(col, "n", (F.col("s") / F.col("n")).alias("mean"), value.alias("value"))
    return TargetEncoding(col, prior, table, k, {"m": m, "kind": "m_estimate"})


# ------------------------------------------------------------------ scaling
@dataclass
class Scaling:
    """Per column mean and population standard deviation."""
    mean: dict[str, float]
    std: dict[str, float]

    def transform(self, df: DataFrame) -> DataFrame:
        out = []
        for c in df.columns:
            if c in self.mean:
                s = self.std[c]
                s = s if (s is not None and s > 0 and not math.isnan(s)) else 1.0
                out.append(((F.col(c).cast("double") - F.lit(self.mean[c])) / F.lit(s)).alias(c))
            else:
                out.append(F.col(c))
        return df.select(*out)

    def to_frame(self, spark: SparkSession) -> DataFrame:
        rows = [(c, float(self.mean[c]), float(self.std[c])) for c in self.mean]
        schema = T.StructType([T.StructField("column", T.StringType()),
                               T.StructField("mean", T.DoubleType()),
                               T.StructField("std", T.DoubleType())])
        return spark.createDataFrame(rows, schema)


def fit_scaling(df: DataFrame, cols: list[str]) -> Scaling:
    """All moments in one aggregate; a constant column scales by 1."""
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"m__{c}"), F.stddev_pop(x).alias(f"s__{c}")]
    row = df.agg(*aggs).first()
    return Scaling({c: row[f"m__{c}"] or 0.0 for c in cols},
                   {c: row[f"s__{c}"] if row[f"s__{c}"] is not None else 0.0 for c in cols})


def standard_scale(train: DataFrame, *others: DataFrame, exclude=(TARGET,), key: str | None = None):
    """Fit on ``train`` (all numeric columns but the target/key), apply to all."""
    skip = set(exclude) | ({key} if key else set())
    cols = [c for c, t in train.dtypes if c not in skip and t in
            ("int", "bigint", "double", "float", "smallint", "tinyint")]
    sc = fit_scaling(train, cols)
    return (sc, sc.transform(train), *[sc.transform(o) for o in others])


# ----------------------------------------------------------------- weights
def balanced_weights(df: DataFrame, target: str = TARGET) -> dict:
    """``class_weight='balanced'`` = n / (k * n_c) and ``n_neg / n_pos``."""
    rows = df.groupBy(target).agg(F.count(F.lit(1)).alias("n")).limit(MAX_CATEGORIES + 1).collect()
    if len(rows) > MAX_CATEGORIES:
        raise ValueError(f"{target} has more than {MAX_CATEGORIES} classes")
    counts = {r[target]: r["n"] for r in rows if r[target] is not None}
    n, k = sum(counts.values()), len(counts)
    weights = {c: n / (k * m) for c, m in counts.items()}
    pos, neg = counts.get(1, 0), counts.get(0, 0)
    return {"counts": counts, "class_weight": weights,
            "scale_pos_weight": (neg / pos) if pos else float("nan")}


def with_weights(df: DataFrame, weights: dict, target: str = TARGET, out: str = "weight") -> DataFrame:
    expr = None
    for c, w in weights.items():
        expr = F.when(F.col(target) == c, F.lit(float(w))) if expr is None else \
            expr.when(F.col(target) == c, F.lit(float(w)))
    return df.withColumn(out, expr.otherwise(F.lit(1.0)))


def class_weight_table(df: DataFrame, target: str = TARGET, digits: int = 9) -> DataFrame:
    """Per class: rows and the balanced weight n / (k * n_c), as a frame."""
    counts = df.groupBy(target).agg(F.count(F.lit(1)).alias("n"))
    total, classes = counts.agg(F.sum("n")).scalar(), counts.agg(F.count(F.lit(1))).scalar()
    return counts.withColumn("class_weight", F.round(total / (classes * F.col("n")), digits))
