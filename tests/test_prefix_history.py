"""Running totals and patient history against brute force (hot key included)."""

import datetime as dt

import pytest

from truant.operators import history
from truant.plans.prefix import running_totals


@pytest.mark.parametrize("rows_per_range", [1000, 40])
def test_running_totals_hot_key(spark, rows_per_range):
    rows = [(0 if i % 3 else i % 7, (i * 37) % 101, i, 1 + i % 4) for i in range(600)]
    df = spark.createDataFrame(rows, "k int, t long, id long, v long")
    out = running_totals(df, "t", ["v"], 600, keys=["k"], tiebreak=["id"], rows_per_range=rows_per_range).collect()
    got = {r.id: r.cum_v for r in out}
    for k, t, i, _ in rows:
        exp = sum(v for k2, t2, i2, v in rows if k2 == k and (t2, i2) <= (t, i))
        assert got[i] == exp


@pytest.mark.parametrize("rows_per_range", [1000, 40])
def test_running_totals_of_ties(spark, rows_per_range):
    rows = [(i, float(i * 7 % 13), 1) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, t double, v long")
    for down in (False, True):
        for r in running_totals(df, "t", ["v"], 300, descending=down, rows_per_range=rows_per_range).collect():
            assert r.cum_v == sum(1 for _, t, _ in rows if (t >= r.t if down else t <= r.t))


# an ordinary patient, and one that is handled in ranges
@pytest.mark.parametrize("sizes", [{}, {"max_group": 25, "rows_per_range": 9}])
def test_prior_misses_brute_force(spark, sizes):
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(80):
        pid = (1.0 if i % 4 else float(i % 3)) if i % 10 else None
        sched = base + dt.timedelta(hours=7 * i % 300)
        appt = base + dt.timedelta(days=(i * 5) % 17 - 2)
        rows.append((pid, i, sched, appt, i % 3 == 0 and 1 or 0))
    df = spark.createDataFrame(rows, "PATIENTID double, APPOINTMENTID long, SCHEDULEDDAY timestamp,"
                                     " APPOINTMENTDAY timestamp, NO_SHOW int")
    got = {r.APPOINTMENTID: (r.prior_known, r.prior_misses) for r in history.prior_misses(df, **sizes).collect()}
    for p, i, s, a, y in rows:
        others = [(y2) for p2, i2, s2, a2, y2 in rows if p is not None and p2 == p and i2 != i and a2 < s]
        assert got[i] == (len(others), sum(others))
    pa = {r.APPOINTMENTID: r.prior_appointments for r in history.prior_appointments(df, **sizes).collect()}
    for p, i, s, a, y in rows:
        assert pa[i] == sum(1 for p2, i2, s2, _, _ in rows if p is not None and p2 == p and (s2, i2) < (s, i))
    assert len(got) == len(pa) == 80


def test_unknown_times_and_empty_table(spark):
    schema = "PATIENTID double, APPOINTMENTID long, SCHEDULEDDAY timestamp, APPOINTMENTDAY timestamp, NO_SHOW int"
    day = dt.datetime(2024, 1, 1)
    rows = [(1.0, 1, day, day, 1), (1.0, 2, None, day, 1), (1.0, 3, day + dt.timedelta(days=2), None, 0), (1.0, None, day, day, None)]
    df = spark.createDataFrame(rows, schema)
    got = {r.APPOINTMENTID: (r.prior_known, r.prior_misses) for r in history.prior_misses(df).collect()}
    assert got == {1: (0, 0), 2: (0, 0), 3: (2, 2), None: (0, 0)}
    assert {r.APPOINTMENTID: r.prior_appointments for r in history.prior_appointments(df).collect()}[2] == 3
    none = spark.createDataFrame([], schema)
    assert history.prior_misses(none).count() == history.prior_appointments(none).count() == 0
