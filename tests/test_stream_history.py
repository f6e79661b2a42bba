"""Patient histories on a stream equal those of the whole table; replays, late rows and forgotten patients."""

import random
import shutil
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from truant.operators import history
from truant.streaming import history as sh

SCHEMA = "PATIENTID double, APPOINTMENTID long, SCHEDULEDDAY timestamp, APPOINTMENTDAY timestamp, NO_SHOW int"
START = datetime(2016, 1, 1, tzinfo=timezone.utc)
COLS = ["APPOINTMENTID", "prior_appointments", "prior_known", "prior_misses"]


def rows_of(n=160, seed=1):
    pick = random.Random(seed)
    out = []
    for i in range(n):
        at = START + timedelta(hours=pick.randint(0, 24 * 60))
        out.append((pick.choice([1.0, 2.0, 3.0, 4.0, None]), i, at, at + timedelta(days=pick.randint(-1, 20)), pick.choice([0, 1, 1, None])))
    out += [(1.0, 900, at, at, 1), (1.0, 901, at, at, 0), (1.0, 901, at, at, 0)]  # one time, one key twice
    return sorted(out, key=lambda r: r[2])


def stream(spark, parts, tmp, **options):
    """Each part arrives as a file and is taken in by a run of its own, the end row last."""
    src, out, ck = (str(tmp / d) for d in ("in", "out", "ck"))
    for i, part in enumerate([*parts, None]):
        df = spark.createDataFrame(part, SCHEMA) if part is not None else sh.end_row(spark, spark.createDataFrame([], SCHEMA))
        df.coalesce(1).write.mode("append").parquet(src)
        sh.history_stream(spark.readStream.schema(SCHEMA).parquet(src), out, ck, **options)
    return spark.read.parquet(out), out, ck, src


def batch(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return sorted(tuple(r) for r in history.prior_misses(history.prior_appointments(df)).select(*COLS).collect())


def got(df):
    return sorted(tuple(r) for r in df.select(*COLS).collect())


def test_parts_give_what_the_union_gives(spark, tmp_path):
    rows = rows_of()
    df, out, ck, src = stream(spark, [rows[:60], rows[60:]], tmp_path)
    once = got(df)
    assert once == batch(spark, rows)

    # the last batch runs again: its commit is gone, as after a lost driver
    last = max(int(p.name) for p in (tmp_path / "ck" / "commits").iterdir() if p.name.isdigit())
    for p in (tmp_path / "ck" / "commits").iterdir():
        if p.name.strip(".").removesuffix(".crc") == str(last):
            shutil.move(p, tmp_path / f"taken-{p.name}")
    sh.history_stream(spark.readStream.schema(SCHEMA).parquet(src), out, ck)
    assert got(spark.read.parquet(out)) == once


def test_late_row_is_found(spark, tmp_path):
    day = lambda d: START + timedelta(days=d)
    first = [(1.0, 1, day(0), day(1), 1), (1.0, 2, day(30), day(31), 0)]
    middle = [(9.0, 3, day(40), day(41), 0)]
    late = [(1.0, 4, day(2), day(3), 1), (1.0, 5, day(60), day(61), 0), (1.0, 6, None, day(50), 1)]
    df, *_ = stream(spark, [first, middle, late], tmp_path)
    r = {x.APPOINTMENTID: x for x in df.collect()}
    arrived = spark.createDataFrame(first + middle + late, SCHEMA)
    assert [x.APPOINTMENTID for x in sh.without_history(arrived, df).collect()] == [4]
    assert (r[5].prior_appointments, r[5].prior_known, r[5].prior_misses) == (2, 3, 2)
    assert (r[6].prior_appointments, r[6].prior_known) == (None, 0)


def test_forgotten_after_expire_days():
    day = 86_400_000_000
    p = sh.Patient(None)
    p.waiting, p.outcomes, p.last = [(day, 1, 2 * day, 1, 1)], [(2 * day, 1, 1)], day
    assert p.take(5 * day) == [(1, 0, 0, 0)]
    assert (p.n, p.known, p.missed, p.waiting, p.outcomes) == (1, 1, 1, [], [])

    class State:
        def __init__(self, watermark, values=None):
            self.exists, self.get, self.hasTimedOut, self.removed, self.at, self.wm = values is not None, values, False, False, None, watermark

        def getCurrentWatermarkMs(self):
            return self.wm

        def update(self, values):
            self.get = values

        def remove(self):
            self.removed = True

        def setTimeoutTimestamp(self, at):
            assert at > self.wm
            self.at = at

    step = sh._step(10 * day)
    held = State(5 * day // 1000, p.values())
    assert list(step((1.0, None), iter([]), held)) == [] and not held.removed and held.at == 11 * day // 1000 + 1
    gone = State(12 * day // 1000, p.values())
    list(step((1.0, None), iter([]), gone))
    assert gone.removed


@pytest.mark.parametrize("seed", range(5))
def test_state_survives_its_own_values(seed):
    """Taking a patient's rows at any watermarks, with the state written and read between, gives the same counts as at once."""
    pick = random.Random(seed)
    rows = sorted((pick.randint(0, 99), k, pick.randint(0, 120), pick.randint(0, 1), 0) for k in range(40))
    rows = [(t, k, d, n, pick.randint(0, n)) for t, k, d, n, _ in rows]

    def run(cuts):
        p, out = sh.Patient(None), []
        p.waiting, p.outcomes = list(rows), sorted((d, n, m) for _, _, d, n, m in rows)
        for c in cuts:
            out += p.take(c)
            p = sh.Patient(p.values())
        return out

    assert run(sorted(pick.sample(range(100), 6)) + [1000]) == run([1000])


def test_counts_are_not_collected(spark):
    """The patient history of a batch frame, for comparison, has one window and no Python."""
    df = spark.createDataFrame(rows_of(20), SCHEMA)
    assert "Python" not in history.prior_appointments(df)._jdf.queryExecution().executedPlan().toString()
    assert df.where(F.col("PATIENTID").isNull()).count() > 0
