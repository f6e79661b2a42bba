"""Profiling aggregates: counts, null profile, miss rates, distributions.

All are single-pass grouped aggregates (partial aggregation before the
shuffle).  Where a total is needed next to per-group rows, the total comes
from the already-aggregated frame, never from a second scan of the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from truant.functions.bands import case_band
from truant.functions.dates import days_between_calendar
from truant.schema import TARGET


def _missed(target: str = TARGET, yes: str = "Yes") -> Column:
    return F.when(F.col(target) == yes, 1).otherwise(0)


def pct(num: Column, den: Column, digits: int = 1) -> Column:
    """Warehouse ``ROUND(num / den * 100, 1)`` on doubles (half away from zero)."""
    return F.round(num / den * 100, digits)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).cast("long").alias("n_cols"))


# The output names of the warehouse queries
# (Total_Appointments, No_Show_Appointments, No_Show_Percentage,
# Show_Appointments, Show_Percentage, Missed_Appointments, Percentage_Missed,
# DaysDifference, AgeGroup, Missing_<column>) are used below as they are there.


def noshow_overview(df: DataFrame, target: str = TARGET) -> DataFrame:
    """Totals and both percentages in one ungrouped aggregate."""
    n = F.count(F.lit(1))
    yes = F.sum(_missed(target, "Yes")).cast("long")
    no = F.sum(_missed(target, "No")).cast("long")
    return df.agg(
        n.alias("Total_Appointments"),
        yes.alias("No_Show_Appointments"),
        pct(yes, n).alias("No_Show_Percentage"),
        no.alias("Show_Appointments"),
        pct(no, n).alias("Show_Percentage"),
    )


def null_profile(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """One row, ``Missing_<col>`` per column, computed in a single scan."""
    cols = cols or df.columns
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"Missing_{c}") for c in cols])


def null_shares(df: DataFrame, cols: list[str] | None = None) -> dict[str, float]:
    """Null share per column from one scan (a one-row result on the driver)."""
    cols = cols or df.columns
    row = df.agg(F.count(F.lit(1)).alias("__n"),
                 *[F.count_if(F.col(c).isNull()).alias(c) for c in cols]).first()
    n = row["__n"] or 0
    return {c: (row[c] / n if n else 0.0) for c in cols}


def drop_sparse_columns(df: DataFrame, max_null_share: float = 0.8) -> DataFrame:
    """Drop columns whose null share exceeds ``max_null_share``."""
    shares = null_shares(df)
    drop = [c for c, s in shares.items() if s > max_null_share]
    return df.drop(*drop) if drop else df


def rate_by(df: DataFrame, key: Column, key_name: str, target: str = TARGET) -> DataFrame:
    """Group -> total, missed, percentage missed."""
    n = F.count(F.lit(1))
    missed = F.sum(_missed(target)).cast("long")
    return (df.groupBy(key.alias(key_name))
              .agg(n.alias("Total_Appointments"), missed.alias("Missed_Appointments"),
                   pct(missed, n).alias("Percentage_Missed")))


def rate_by_gender(df: DataFrame) -> DataFrame:
    return rate_by(df, F.col("GENDER"), "GENDER")


def rate_by_days(df: DataFrame) -> DataFrame:
    return rate_by(df, days_between_calendar(), "DaysDifference").orderBy("DaysDifference")


def rate_by_age_group(df: DataFrame) -> DataFrame:
    return rate_by(df, case_band("AGE"), "AgeGroup").orderBy("AgeGroup")


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Count per value, most frequent first (ties by value)."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), F.asc(col))


def with_share(counts: DataFrame, count_col: str = "count", out: str = "percentage",
               digits: int = 1) -> DataFrame:
    """Attach ``count / total * 100``, the total a scalar subquery over the
    grouped rows (their exchange is reused)."""
    total = counts.agg(F.sum(count_col)).scalar()
    return counts.withColumn(out, F.round(F.col(count_col) / total * 100, digits))


def value_shares(df: DataFrame, col: str, digits: int = 1) -> DataFrame:
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    return with_share(counts, "count", "percentage", digits).drop("count")


def class_distribution(df: DataFrame, target: str = TARGET) -> DataFrame:
    counts = df.groupBy(target).agg(F.count(F.lit(1)).alias("count"))
    return with_share(counts, "count", "percentage", 2)


def join_distribution(df: DataFrame, target: str = TARGET) -> DataFrame:
    """Counts and percentages built separately and joined on the class, the
    shape of the reference's merge.  Both sides have one row per class."""
    counts = df.groupBy(target).agg(F.count(F.lit(1)).alias("count"))
    shares = with_share(counts, "count", "percentage", 2).drop("count")
    return counts.join(shares, target, "inner")


def distinct_count(df: DataFrame, cols: list[str] | None = None, exact: bool = True) -> DataFrame:
    """``n_distinct_<col>`` per column.

    Exact: one scan of the rows, each giving its values in long form.  Whole
    numbers, dates and times go 64 neighbours to a bitmap, so that dense ones
    (keys, ages, flags) collapse 64-fold in the scanning tasks; other values are
    grouped as they are.  ``exact=False`` counts by HyperLogLog++ (relative
    error 5 %, constant memory per column).
    """
    cols = cols or df.columns
    if not exact:
        return df.agg(*[F.approx_count_distinct(F.col(c)).cast("long").alias(f"n_distinct_{c}") for c in cols])
    none = F.lit(None)
    values = []
    for i, c in enumerate(cols):
        number = _whole_number(F.col(c), df.schema[c].dataType)
        word = none.cast("long") if number is None else F.shiftright(number, 6)
        bit = F.lit(1).cast("long") if number is None else F.call_function("shiftleft", F.lit(1).cast("long"), number.bitwiseAND(F.lit(63)).cast("int"))
        other = none.cast("string") if number is not None else _as_text(F.col(c), df.schema[c].dataType)
        values.append(F.struct(F.lit(i).alias("__c"), word.alias("__word"), other.alias("__other"), F.when(F.col(c).isNotNull(), bit).alias("__bit")))
    words = df.select(F.inline(F.array(*values))).where("__bit is not null").groupBy("__c", "__word", "__other").agg(F.bit_or("__bit").alias("__bits"))
    return words.agg(*[F.coalesce(F.sum(F.when(F.col("__c") == i, F.bit_count("__bits"))), F.lit(0)).cast("long").alias(f"n_distinct_{c}")
                       for i, c in enumerate(cols)])


def _whole_number(c: Column, kind: T.DataType) -> Column | None:
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType)):
        return c.cast("long")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("long")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c)
    return None


def _as_text(c: Column, kind: T.DataType) -> Column:
    """A text that tells a type's values apart: -0.0 and 0.0 are one value, as they are in a group."""
    return (c + F.lit(0.0)).cast("string") if isinstance(kind, (T.FloatType, T.DoubleType)) else c.cast("string")


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()


def min_max(df: DataFrame, col: str = "AGE") -> DataFrame:
    return df.agg(F.min(col).alias(f"min_{col}"), F.max(col).alias(f"max_{col}"))


def _long_form(wide: DataFrame, cols: list[str], fields: list[str]) -> DataFrame:
    """One wide row ``<field>__<col>`` -> long rows (column, field...)."""
    structs = [F.struct(F.lit(c).alias("column"),
                        *[F.col(f"{f}__{c}").alias(f) for f in fields]) for c in cols]
    return wide.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def constant_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """Columns with exactly one distinct non-null value (pandas ``nunique() == 1``).

    One pass: min and max per column instead of a distinct count.
    """
    aggs = []
    for c in cols:
        aggs += [F.min(c).alias(f"mn__{c}"), F.max(c).alias(f"mx__{c}")]
    wide = df.agg(*aggs)
    wide = wide.select(*[(F.col(f"mn__{c}").isNotNull() & (F.col(f"mn__{c}") == F.col(f"mx__{c}")))
                         .cast("int").alias(f"is_constant__{c}") for c in cols])
    return _long_form(wide, cols, ["is_constant"])


def constant_column_names(df: DataFrame, cols: list[str]) -> list[str]:
    return [r["column"] for r in constant_columns(df, cols).collect() if r["is_constant"] == 1]


def crosstab(df: DataFrame, a: str, b: str = TARGET) -> DataFrame:
    """Contingency counts in long form (one row per observed cell)."""
    return df.groupBy(a, b).agg(F.count(F.lit(1)).alias("count"))


def moments(df: DataFrame, cols: list[str], digits: int = 9) -> DataFrame:
    """Mean, population and sample standard deviation per column, one scan."""
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        # "+ 0.0" folds a rounded -0.0 into 0.0
        aggs += [(F.round(F.avg(x), digits) + 0.0).alias(f"mean__{c}"),
                 (F.round(F.stddev_pop(x), digits) + 0.0).alias(f"std_pop__{c}"),
                 (F.round(F.stddev_samp(x), digits) + 0.0).alias(f"std_samp__{c}")]
    return _long_form(df.agg(*aggs), cols, ["mean", "std_pop", "std_samp"])


def check_scaling(df: DataFrame, cols: list[str], tol: float = 0.2) -> DataFrame:
    """Per column: |mean| <= tol and |std - 1| <= tol (population std)."""
    m = moments(df, cols)
    ok = (F.abs(F.col("mean")) <= tol) & (F.abs(F.col("std_pop") - 1) <= tol)
    return m.select("column", "mean", "std_pop", ok.cast("int").alias("ok"))

