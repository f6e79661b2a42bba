"""Mergeable profiles: what each load of a growing table adds, kept as a small table.

A state has one row per load and column: rows, nulls, count, mean and sum of
squared deviations of the numbers, least and greatest value, and a HyperLogLog
sketch of the distinct values.  States of disjoint loads merge to the state of
their union without reading the rows again, in any order and grouping; the
deviations are merged about the common mean, so that nothing is lost to
cancellation.  Counts and extremes are exact, distinct counts have the sketch's
error (about 1.6 % at LG_K = 12).

A load written again replaces its own rows; one without rows has no state.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

LG_K = 12
LOAD = "load"


def _number(c: Column, kind: T.DataType) -> Column | None:
    """The value as a double, for columns with an order of magnitude; times in microseconds."""
    if isinstance(kind, T.NumericType):
        return c.cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    return None


def profile_state(df: DataFrame, load: Column | str, cols: list[str] | None = None) -> DataFrame:
    """(load, column, rows, nulls, n, mean, m2, least, greatest, least_text, greatest_text, distinct): one row per load and column.

    ``load`` names each row's load: a constant, or a column expression where one
    scan has several.  Texts have extremes of their own, and no moments.
    """
    load = (F.lit(load) if isinstance(load, str) else load).cast("string")
    cols = cols or df.columns
    none = F.lit(None).cast("double")
    parts, fields = [], ("rows", "nulls", "n", "mean", "m2", "least", "greatest", "least_text", "greatest_text", "distinct")
    for i, c in enumerate(cols):
        x = _number(F.col(c), df.schema[c].dataType)
        text = F.col(c).cast("string") if x is None else F.lit(None).cast("string")
        x = none if x is None else x
        parts += [F.count(F.lit(1)).alias(f"{i}_rows"), F.count_if(F.col(c).isNull()).alias(f"{i}_nulls"), F.count(x).alias(f"{i}_n"),
                  F.avg(x).alias(f"{i}_mean"), (F.var_pop(x) * F.count(x)).alias(f"{i}_m2"), F.min(x).alias(f"{i}_least"), F.max(x).alias(f"{i}_greatest"),
                  F.min(text).alias(f"{i}_least_text"), F.max(text).alias(f"{i}_greatest_text"),
                  F.hll_sketch_agg(F.col(c).cast("string"), LG_K).alias(f"{i}_distinct")]
    wide = df.groupBy(load.alias(LOAD)).agg(*parts)
    long = [F.struct(F.lit(c).alias("column"), *[F.col(f"{i}_{f}").alias(f) for f in fields]) for i, c in enumerate(cols)]
    return wide.select(LOAD, F.inline(F.array(*long)))


def merge_states(states: DataFrame, by: list[str] | None = None) -> DataFrame:
    """One row per column (and ``by``) for all the loads in ``states``, in the same form, without ``load``."""
    keys = [*(by or []), "column"]
    w = Window.partitionBy(*keys)  # one row per load
    whole = F.sum(F.col("n") * F.col("mean")).over(w) / F.sum("n").over(w)
    about = F.col("m2") + F.col("n") * (F.col("mean") - F.col("__whole")) * (F.col("mean") - F.col("__whole"))
    return states.withColumn("__whole", whole).groupBy(*keys).agg(
        F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"), F.sum("n").alias("n"), F.max("__whole").alias("mean"), F.sum(about).alias("m2"),
        F.min("least").alias("least"), F.max("greatest").alias("greatest"), F.min("least_text").alias("least_text"), F.max("greatest_text").alias("greatest_text"),
        F.hll_union_agg("distinct").alias("distinct"))


def profile(merged: DataFrame, digits: int = 9) -> DataFrame:
    """(column, rows, nulls, mean, std_pop, std_samp, least, greatest, least_text, greatest_text, distinct_estimate) of a merged state."""
    rounded = lambda c: F.round(c, digits) + 0.0  # noqa: E731  "+ 0.0" folds a rounded -0.0 into 0.0
    return merged.select(
        *[c for c in merged.columns if c not in ("n", "mean", "m2", "least", "greatest", "least_text", "greatest_text", "distinct")],
        rounded(F.col("mean")).alias("mean"), rounded(F.when(F.col("n") > 0, F.sqrt(F.col("m2") / F.col("n")))).alias("std_pop"),
        rounded(F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1)))).alias("std_samp"), "least", "greatest", "least_text", "greatest_text",
        F.hll_sketch_estimate("distinct").alias("distinct_estimate"))


def write_state(state: DataFrame, path: str) -> None:
    """Add the loads in ``state`` to the table at ``path``; a load that is there already is replaced."""
    state.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(LOAD).parquet(path)


def read_state(spark, path: str) -> DataFrame:
    """All loads kept at ``path``; a filter on ``load`` reads only those."""
    return spark.read.parquet(path).withColumn(LOAD, F.col(LOAD).cast("string"))
