"""Date and time column functions (all JVM-side, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from truant.schema import APPOINTMENT, SCHEDULED

MICROS_PER_DAY = 86_400_000_000

# The run-stamp zone and pattern of the scoring output.
RUN_STAMP_ZONE = "America/Vancouver"
RUN_STAMP_PATTERN = "yyyyMMdd_HHmmss"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_timestamp(c) -> Column:
    """Timestamps may arrive as ``timestamp_ntz``; cast once at the edge."""
    return _col(c).cast("timestamp")


def days_between_calendar(start=SCHEDULED, end=APPOINTMENT) -> Column:
    """Warehouse ``DATEDIFF(day, start, end)``: calendar-day boundaries."""
    return F.datediff(_col(end), _col(start))


def days_till_appointment(start=SCHEDULED, end=APPOINTMENT) -> Column:
    """floor((end - start) in days) + 1; the floor matters for a negative gap."""
    diff = F.unix_micros(as_timestamp(end)) - F.unix_micros(as_timestamp(start))
    return (F.floor(diff / F.lit(MICROS_PER_DAY)) + 1).cast("long")


def date_part_columns(cols=(SCHEDULED, APPOINTMENT)) -> dict[str, Column]:
    """``<COL>_YEAR/_MONTH/_DAY`` for each timestamp column (session zone UTC)."""
    out: dict[str, Column] = {}
    for c in cols:
        out[f"{c}_YEAR"] = F.year(_col(c))
        out[f"{c}_MONTH"] = F.month(_col(c))
        out[f"{c}_DAY"] = F.dayofmonth(_col(c))
    return out


def run_stamp(ts="ts", zone: str = RUN_STAMP_ZONE, pattern: str = RUN_STAMP_PATTERN) -> Column:
    """UTC instant -> local wall-clock text stamp, e.g. ``20240101_040000``."""
    return F.date_format(F.from_utc_timestamp(as_timestamp(ts), zone), pattern)


def parse_timestamp(c, fmt: str | None = None) -> Column:
    """Lenient timestamp parsing: unparseable text becomes null, not an error."""
    return F.try_to_timestamp(_col(c), F.lit(fmt)) if fmt else F.try_to_timestamp(_col(c))
