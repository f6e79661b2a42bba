"""Feature columns of the model table (narrow projections, no shuffle)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from truant.functions.bands import age_bucket, gender_age
from truant.functions.dates import date_part_columns, days_till_appointment
from truant.operators.clean import reorder_target_last
from truant.schema import APPOINTMENT, SCHEDULED

DATE_PARTS = [f"{c}_{p}" for c in (SCHEDULED, APPOINTMENT) for p in ("YEAR", "MONTH", "DAY")]
YEAR_PARTS = [f"{SCHEDULED}_YEAR", f"{APPOINTMENT}_YEAR"]


def add_age_bucket(df: DataFrame, out: str = "AGE_BUCKET") -> DataFrame:
    return df.withColumn(out, age_bucket("AGE"))


def add_gender_age(df: DataFrame) -> DataFrame:
    return reorder_target_last(df.withColumn("GENDER_AGE", gender_age("GENDER", "AGE")))


def add_days_till(df: DataFrame) -> DataFrame:
    return reorder_target_last(df.withColumn("DAYS_TILL_APPOINTMENT", days_till_appointment()))


def add_date_parts(df: DataFrame, drop_years: list[str] | None = None) -> DataFrame:
    """Year/month/day of both dates, the dates dropped.  ``drop_years`` is
    decided once at fit time (constant year columns), not per frame."""
    out = df.withColumns(date_part_columns()).drop(SCHEDULED, APPOINTMENT)
    if drop_years:
        out = out.drop(*drop_years)
    return reorder_target_last(out)
