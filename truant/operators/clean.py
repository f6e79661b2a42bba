"""Cleaning, projection and row filters (narrow transformations, no shuffle)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from truant.functions.dates import days_till_appointment
from truant.schema import COLUMN_ALIASES, GENDER_MAP, KEY, PATIENT, TARGET, TARGET_MAP


def normalize_columns(df: DataFrame, aliases: dict[str, str] | None = None) -> DataFrame:
    """Trim and upper-case column names, then apply the source-spelling aliases."""
    aliases = COLUMN_ALIASES if aliases is None else aliases
    names = []
    for c in df.columns:
        u = c.strip().upper()
        names.append(aliases.get(u, u))
    return df.toDF(*names)


def project_cols(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*cols)


def drop_cols(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.drop(*cols)


def duplicate_keys(df: DataFrame, key: str = KEY) -> DataFrame:
    """Keys that occur more than once (empty when ``key`` is a valid key)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def set_key(df: DataFrame, key: str = KEY, check: bool = False) -> DataFrame:
    """Make ``key`` the leading column; optionally assert uniqueness (one job)."""
    if check and duplicate_keys(df, key).limit(1).count() > 0:
        raise ValueError(f"{key} is not unique")
    return df.select(key, *[c for c in df.columns if c != key])


def reorder_target_last(df: DataFrame, target: str = TARGET) -> DataFrame:
    if target not in df.columns:
        return df
    return df.select(*[c for c in df.columns if c != target], target)


def map_values(c, mapping: dict) -> Column:
    """Dictionary lookup; unmatched values (and null) become null."""
    col = F.col(c) if isinstance(c, str) else c
    expr = None
    for k, v in mapping.items():
        expr = F.when(col == k, F.lit(v)) if expr is None else expr.when(col == k, F.lit(v))
    return expr


def encode_target(df: DataFrame, target: str = TARGET) -> DataFrame:
    return df.withColumn(target, map_values(target, TARGET_MAP).cast("int"))


def encode_gender(df: DataFrame, col: str = "GENDER") -> DataFrame:
    return df.withColumn(col, map_values(col, GENDER_MAP).cast("int"))


def valid_dates(start="SCHEDULEDDAY", end="APPOINTMENTDAY") -> Column:
    return days_till_appointment(start, end) >= 0


def filter_valid_dates(df: DataFrame) -> DataFrame:
    return df.filter(valid_dates())


def list_invalid_dates(df: DataFrame) -> DataFrame:
    """Rows whose waiting days are negative, with the offending value."""
    d = days_till_appointment()
    return df.filter(d < 0).withColumn("DAYS_TILL_APPOINTMENT", d)


def filter_valid_age(df: DataFrame, col: str = "AGE") -> DataFrame:
    return df.filter(F.col(col) >= 0)


def list_invalid_age(df: DataFrame, col: str = "AGE") -> DataFrame:
    return df.filter(F.col(col) < 0)


def preprocess(df: DataFrame, is_simulated: bool = False) -> DataFrame:
    """Drop the patient id, key first, encode the target, drop invalid rows.

    Null waiting days or ages fail the comparisons and are dropped, like
    NaN/NaT comparisons in the original.
    """
    out = df.drop(PATIENT)
    out = set_key(out)
    if not is_simulated and TARGET in out.columns:
        out = encode_target(out)
    return out.filter(valid_dates()).filter(F.col("AGE") >= 0)


def usable() -> Column:
    """Whether :func:`preprocess` keeps a row; never null."""
    return F.coalesce(valid_dates() & (F.col("AGE") >= 0), F.lit(False))


def filter_class(df: DataFrame, value, target: str = TARGET) -> DataFrame:
    return df.filter(F.col(target) == value)


def blank_target(df: DataFrame, target: str = TARGET) -> DataFrame:
    """Overwrite the target with null (the unlabelled scoring set)."""
    dtype = dict(df.dtypes).get(target, "string")
    return df.withColumn(target, F.lit(None).cast(dtype))


def select_features(df: DataFrame, features: list[str], target: str = TARGET,
                    key: str | None = KEY) -> DataFrame:
    """Fixed feature list: absent columns become 0, nulls become 0 (the
    documented intent of the original filter), target kept when present."""
    have = set(df.columns)
    cols = [key] if key and key in have else []
    for f in features:
        cols.append((F.coalesce(F.col(f), F.lit(0)) if f in have else F.lit(0)).alias(f))
    if target in have:
        cols.append(F.col(target))
    return df.select(*cols)


def align_schema(a: DataFrame, b: DataFrame) -> dict:
    """Schema comparisons of the notebook: same names in the same order,
    all-int / all-numeric / any string column, per frame."""
    def kinds(df):
        types = [t for _, t in df.dtypes]
        return {
            "all_int": all(t in ("int", "bigint", "smallint", "tinyint") for t in types),
            "all_numeric": all(t in ("int", "bigint", "smallint", "tinyint", "double", "float")
                               or t.startswith("decimal") for t in types),
            "any_string": any(t == "string" for t in types),
        }
    return {
        "same_columns": a.columns == b.columns,
        "same_column_set": set(a.columns) == set(b.columns),
        "left": kinds(a),
        "right": kinds(b),
        "only_left": sorted(set(a.columns) - set(b.columns)),
        "only_right": sorted(set(b.columns) - set(a.columns)),
    }


def align_report(a: DataFrame, b: DataFrame) -> DataFrame:
    """(column, left_type, right_type, left_place, right_place, right_rows, not_castable): one row for every column of either frame.

    ``not_castable`` counts the values of ``b`` that are lost if its column is
    cast to the type it has in ``a``; one scan of ``b`` counts them all."""
    left, right = dict(a.dtypes), dict(b.dtypes)
    both = [c for c in a.columns if c in right]
    lost = b.agg(F.count(F.lit(1)).alias("__rows"), *[F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(left[c]).isNull()).alias(c) for c in both])
    text, place = (lambda d, c: F.lit(d.get(c)).cast("string")), (lambda df, c: F.lit(df.columns.index(c) + 1 if c in df.columns else None).cast("int"))
    rows = [F.struct(F.lit(c).alias("column"), text(left, c).alias("left_type"), text(right, c).alias("right_type"), place(a, c).alias("left_place"),
                     place(b, c).alias("right_place"), F.col("__rows").alias("right_rows"), (F.col(c) if c in both else F.lit(None).cast("long")).alias("not_castable"))
            for c in dict.fromkeys([*a.columns, *b.columns])]
    return lost.select(F.inline(F.array(*rows)))
