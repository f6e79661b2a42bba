"""Patient history features (recommended by the original, built here).

Both are running counts per patient: one window partitioned by patient.  A
patient with more than ``max_group`` rows (found by a count, so at most one
per ``max_group`` rows) is handled apart, by
:func:`truant.plans.prefix.running_totals`, whose ranges over time spread its
rows over many tasks.

Rows without a patient have no history: their counts are 0 and they count for
nobody; a hash of the row spreads them over the tasks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from truant.plans.joins import broadcast_if_small
from truant.plans.prefix import ROWS_PER_RANGE, running_totals
from truant.schema import APPOINTMENT, KEY, PATIENT, SCHEDULED, TARGET

MAX_GROUP = 1_000_000


def _micros(c: str) -> Column:
    return F.unix_micros(F.col(c).cast("timestamp"))


def _by_size(df: DataFrame, patient: str, max_group: int, plain: Callable[[DataFrame], DataFrame],
             hot: Callable[[DataFrame, int], DataFrame]) -> DataFrame:
    """``plain`` on the rows of ordinary patients, ``hot`` on those of patients with more than ``max_group`` rows."""
    big = df.where(F.col(patient).isNotNull()).groupBy(patient).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > max_group)
    some = big.agg(F.count(F.lit(1)), F.sum("__n")).first()
    if not some[0]:
        return plain(df)
    keys = broadcast_if_small(big.select(patient), some[0])
    return plain(df.join(keys, patient, "left_anti")).unionByName(hot(df.join(keys, patient, "left_semi"), some[1]))


def _alone(df: DataFrame, patient: str) -> Column:
    return F.when(F.col(patient).isNull(), F.xxhash64(*df.columns))


def prior_appointments(df: DataFrame, patient: str = PATIENT, key: str = KEY, out: str = "prior_appointments",
                       max_group: int = MAX_GROUP, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Number of the patient's appointments scheduled before this one (ties
    on the scheduling time broken by key; an unknown time is the last)."""
    last = F.lit((1 << 63) - 1)

    def plain(rows: DataFrame) -> DataFrame:
        w = Window.partitionBy(patient, _alone(rows, patient)).orderBy(F.coalesce(_micros(SCHEDULED), last), key)
        before = F.when(F.col(patient).isNull(), F.lit(0)).otherwise(F.row_number().over(w) - 1)
        return rows.withColumn(out, before.cast("long"))

    def hot(rows: DataFrame, n: int) -> DataFrame:
        base = rows.withColumn("__t", F.coalesce(_micros(SCHEDULED), last)).withColumn("__one", F.lit(1).cast("long"))
        r = running_totals(base, "__t", ["__one"], n, keys=[patient], tiebreak=[key], rows_per_range=rows_per_range)
        return r.withColumn(out, F.col("cum___one") - 1).drop("__t", "__one", "cum___one")

    return _by_size(df, patient, max_group, plain, hot)


def prior_misses(df: DataFrame, patient: str = PATIENT, key: str = KEY, target: str = TARGET,
                 max_group: int = MAX_GROUP, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Per appointment: the patient's other appointments whose day lies
    strictly before this one was scheduled (outcome known by then), and how
    many of those were missed.

    Event sweep: outcome events at the appointment day and query events at
    the scheduling time, ordered by (time, query-before-outcome); a running
    sum at a query event counts exactly the earlier outcomes.  A query event
    carries its row, so nothing is joined back.  An unknown appointment day
    counts for nobody, and an unknown scheduling time has nothing before it.
    """
    missed = F.coalesce(F.col(target).cast("long"), F.lit(0).cast("long"))
    known = F.col(target).isNotNull().cast("long")
    none = F.lit(0).cast("long")
    row = F.struct(*df.columns)

    def events(rows: DataFrame) -> DataFrame:
        # the appointment itself counts only if its own day precedes its own
        # scheduling time (a negative wait); it is taken back out below
        own = F.col(patient).isNotNull() & F.coalesce(_micros(APPOINTMENT) < _micros(SCHEDULED), F.lit(False))
        queries = rows.select(
            F.col(patient).alias("__p"), _alone(rows, patient).alias("__alone"), F.coalesce(_micros(SCHEDULED), F.lit(-(1 << 63))).alias("__t"),
            F.lit(0).alias("__kind"), none.alias("__miss"), none.alias("__known"), row.alias("__row"),
            F.when(own, missed).otherwise(none).alias("__own_miss"), F.when(own, known).otherwise(none).alias("__own_known"))
        outcomes = rows.where(F.col(patient).isNotNull() & F.col(APPOINTMENT).isNotNull()).select(
            F.col(patient).alias("__p"), F.lit(None).cast("long").alias("__alone"), _micros(APPOINTMENT).alias("__t"),
            F.lit(1).alias("__kind"), missed.alias("__miss"), known.alias("__known"), F.when(F.lit(False), row).alias("__row"),
            none.alias("__own_miss"), none.alias("__own_known"))
        return queries.unionByName(outcomes)

    def answers(swept: DataFrame) -> DataFrame:
        return swept.where("__kind = 0").select(
            "__row.*", (F.col("cum___known") - F.col("__own_known")).alias("prior_known"),
            (F.col("cum___miss") - F.col("__own_miss")).alias("prior_misses"))

    def plain(rows: DataFrame) -> DataFrame:
        w = Window.partitionBy("__p", "__alone").orderBy("__t", "__kind").rowsBetween(Window.unboundedPreceding, 0)
        return answers(events(rows).withColumns({f"cum_{c}": F.sum(c).over(w) for c in ("__miss", "__known")}))

    def hot(rows: DataFrame, n: int) -> DataFrame:
        return answers(running_totals(events(rows), "__t", ["__miss", "__known"], 2 * n, keys=["__p"],
                                      tiebreak=["__kind"], rows_per_range=rows_per_range))

    return _by_size(df, patient, max_group, plain, hot)
