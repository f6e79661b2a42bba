"""Patient history on a stream of appointments: keyed state per patient.

A row's history is known once no earlier appointment of its patient can
arrive, so a row waits in its patient's state until the watermark (the latest
scheduling time seen, less ``delay``) has passed its own scheduling time.  Then
it gets the counts that :mod:`truant.operators.history` gives it on the whole
table.  ``delay`` covers both late files and appointments whose day lies before
the time they were scheduled; rows later than that are dropped by Spark's keyed
state (and counted in the query's progress), :func:`without_history` finds them.

What a patient's state holds is bounded by the patient's rows and outcomes
after the watermark: older ones are folded into three counts.  With
``expire_days`` a patient who has no appointment for so long is forgotten,
and starts anew.  Each micro-batch writes by its number, so a batch that is
run again after a failure replaces its own rows.

Rows without a patient are groups of their own with no history; a row without
a scheduling time comes out at once, and only its outcome counts.  The rows of
one patient are one task's work, as keyed state has it.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from truant.schema import APPOINTMENT, KEY, PATIENT, SCHEDULED, TARGET
from truant.session import ship_package

OUT = f"{PATIENT} double, {KEY} long, prior_appointments long, prior_known long, prior_misses long"
#: Counts of what lies before the watermark, the last scheduling time, waiting rows, outcomes after the watermark.
STATE = ("n long, known long, missed long, last long, wait_t array<long>, wait_key array<long>, wait_day array<long>, "
         "wait_known array<long>, wait_missed array<long>, day array<long>, day_known array<long>, day_missed array<long>")
NEVER, NO_KEY = (1 << 63) - 1, -(1 << 63)
#: End of a stream: a row scheduled this far off moves the watermark past all others.
LAST_TIME = "2200-01-01 00:00:00"


class Patient:
    """One patient's state, in the order of the STATE fields."""

    def __init__(self, values: tuple | None):
        n, known, missed, last, *lists = values or (0, 0, 0, -NEVER, *[[] for _ in range(8)])
        self.n, self.known, self.missed, self.last = n, known, missed, last
        self.waiting = sorted(zip(*lists[:5], strict=True))       # (time, key, day, known, missed)
        self.outcomes = sorted(zip(*lists[5:], strict=True))      # (day, known, missed)

    def values(self) -> tuple:
        def columns(rows: list[tuple], width: int) -> list[list[int]]:
            return [[int(r[i]) for r in rows] for i in range(width)]
        return (self.n, self.known, self.missed, self.last, *columns(self.waiting, 5), *columns(self.outcomes, 3))

    def before(self, t: int, day: int, known: int, missed: int) -> tuple[int, int]:
        """Known outcomes and misses of days before ``t``, without the row's own."""
        past = self.outcomes[: bisect.bisect_left(self.outcomes, (t,))]
        own = day < t
        return (self.known + sum(o[1] for o in past) - (known if own else 0),
                self.missed + sum(o[2] for o in past) - (missed if own else 0))

    def take(self, watermark: int) -> list[tuple]:
        """The waiting rows before the watermark, with their counts; older outcomes are folded."""
        cut = bisect.bisect_left(self.waiting, (watermark,))
        ready, self.waiting = self.waiting[:cut], self.waiting[cut:]
        out = []
        for t, key, day, known, missed in ready:
            out.append((key, self.n, *self.before(t, day, known, missed)))
            self.n += 1
        cut = bisect.bisect_left(self.outcomes, (watermark,))
        self.known += sum(o[1] for o in self.outcomes[:cut])
        self.missed += sum(o[2] for o in self.outcomes[:cut])
        self.outcomes = self.outcomes[cut:]
        return out


def _step(expire_micros: int | None):
    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        watermark = max(0, state.getCurrentWatermarkMs()) * 1000
        own = Patient(state.get if state.exists else None)
        out = []
        for b in batches:
            for k, t, day, known, missed in b[["key", "t", "day", "known", "missed"]].itertuples(index=False):
                bisect.insort(own.outcomes, (day, known, missed)) if day != NEVER else None
                if t == NEVER:  # no scheduling time
                    out.append((k, None, 0, 0))
                else:
                    bisect.insort(own.waiting, (t, k, day, known, missed))
                own.last = max(own.last, t if t != NEVER else own.last)
        out += own.take(watermark)
        alone = key[0] is None or pd.isna(key[0])
        expires = own.last + expire_micros if expire_micros is not None else None
        if (alone and not own.waiting) or (not own.waiting and expires is not None and expires < watermark):
            if state.exists:
                state.remove()
        else:
            state.update(own.values())
            at = own.waiting[0][0] if own.waiting else expires
            if at is not None:
                state.setTimeoutTimestamp(max(at // 1000 + 1, state.getCurrentWatermarkMs() + 1))
        if out:
            out = [(None if r[0] == NO_KEY else r[0], *r[1:]) for r in out]
            patient = None if alone else key[0]
            yield pd.DataFrame({PATIENT: pd.Series([patient] * len(out), dtype="float64"),
                                **{c: pd.Series([r[i] for r in out], dtype="Int64") for i, c in enumerate((KEY, "prior_appointments", "prior_known", "prior_misses"))}})

    return step


def history_rows(appointments: DataFrame, delay: str = "7 days", expire_days: int | None = None) -> DataFrame:
    """The streaming frame (PATIENTID, APPOINTMENTID, prior_appointments, prior_known, prior_misses).

    ``appointments`` is a stream with the patient, key, both times and the
    target as 0/1 (null: not known yet, such an outcome is not counted).
    """
    ship_package(appointments.sparkSession)
    micros = lambda c: F.coalesce(F.unix_micros(F.col(c).cast("timestamp")), F.lit(NEVER))
    rows = appointments.withColumn(SCHEDULED, F.col(SCHEDULED).cast("timestamp")).withWatermark(SCHEDULED, delay)
    alone = F.when(F.col(PATIENT).isNull(), F.xxhash64(KEY, SCHEDULED, APPOINTMENT))
    rows = rows.select(F.col(PATIENT).cast("double").alias(PATIENT), alone.alias("alone"), SCHEDULED, F.coalesce(F.col(KEY).cast("long"), F.lit(NO_KEY)).alias("key"),
                       micros(SCHEDULED).alias("t"), micros(APPOINTMENT).alias("day"), F.col(TARGET).isNotNull().cast("long").alias("known"),
                       F.coalesce(F.col(TARGET).cast("long"), F.lit(0)).alias("missed"))
    expire = None if expire_days is None else expire_days * 86_400_000_000
    return rows.groupBy(PATIENT, "alone").applyInPandasWithState(_step(expire), OUT, STATE, "append", GroupStateTimeout.EventTimeTimeout)


def history_stream(appointments: DataFrame, output_dir: str, checkpoint_dir: str, delay: str = "7 days", expire_days: int | None = None,
                   available_now: bool = True, processing_time: str = "1 minute"):
    """Writes :func:`history_rows` to ``output_dir``, a folder for each micro-batch."""

    def batch(df: DataFrame, number: int) -> None:
        df.write.mode("overwrite").parquet(f"{output_dir}/batch={number}")

    w = history_rows(appointments, delay, expire_days).writeStream.outputMode("append").foreachBatch(batch).option("checkpointLocation", checkpoint_dir)
    q = (w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)).start()
    if available_now:
        q.awaitTermination()
    return q


def end_row(spark: SparkSession, like: DataFrame) -> DataFrame:
    """A row of ``like``'s columns that ends a stream: once it has arrived, all earlier rows come out.  It never does itself."""
    value = {SCHEDULED: F.lit(LAST_TIME).cast("timestamp")}
    return spark.range(1).select(*[value.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in like.schema.fields])


def without_history(arrived: DataFrame, histories: DataFrame, key: str = KEY) -> DataFrame:
    """Rows that have arrived but have no history (yet): those that still wait, and those that came too late."""
    return arrived.join(histories.select(key), key, "left_anti")
