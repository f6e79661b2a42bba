"""Scalar functions against the literal edge tables."""

import datetime as dt

from pyspark.sql import functions as F

from truant.functions.bands import age_bucket, case_band, gender_age
from truant.functions.dates import days_between_calendar, days_till_appointment, run_stamp


def ts(s):
    return dt.datetime.fromisoformat(s) if s else None


def test_waiting_days(spark):
    rows = [("2016-04-29 18:38:08", "2016-04-29 00:00:00", 0, 0),
            ("2016-04-29 18:38:08", "2016-04-28 00:00:00", -1, -1),
            ("2016-04-29 00:00:00", "2016-04-29 00:00:00", 0, 1),
            ("2016-04-29 00:00:01", "2016-05-03 00:00:00", 4, 4),
            (None, "2016-05-03 00:00:00", None, None)]
    df = spark.createDataFrame([(ts(a), ts(b)) for a, b, _, _ in rows],
                               "SCHEDULEDDAY timestamp, APPOINTMENTDAY timestamp")
    got = df.select(days_between_calendar().alias("cal"), days_till_appointment().alias("till")).collect()
    assert [(r.cal, r.till) for r in got] == [(c, t) for _, _, c, t in rows]


def test_age_bands(spark):
    ages = [None, -1, 0, 12, 13, 17, 18, 30, 31, 50, 51, 115]
    df = spark.createDataFrame([(a,) for a in ages], "AGE int")
    got = df.select(case_band("AGE").alias("band"), age_bucket("AGE").alias("bucket")).collect()
    assert [r.band for r in got] == ["50+", "50+", "0-12", "0-12", "13-17", "13-17", "18-30", "18-30",
                                     "31-50", "31-50", "50+", "50+"]
    assert [r.bucket for r in got] == [None, None, "0-12", "0-12", "13-17", "13-17", "18-30", "18-30",
                                       "31-50", "31-50", "50+", "50+"]


def test_gender_age_null_propagates(spark):
    df = spark.createDataFrame([("F", 40), ("M", None), (None, 5)], "GENDER string, AGE int")
    assert [r[0] for r in df.select(gender_age()).collect()] == ["F_31-50", None, None]


def test_run_stamp(spark):
    df = spark.createDataFrame([(ts("2024-01-01 12:00:00"),)], "ts timestamp")
    assert df.select(run_stamp("ts")).first()[0] == "20240101_040000"


def test_sized_conf_scales_with_input():
    from truant.session import sized_conf
    small, big = sized_conf(10 ** 9), sized_conf(100 * 10 ** 12)
    assert int(small["spark.sql.shuffle.partitions"]) == 200
    assert int(big["spark.sql.shuffle.partitions"]) == -(-100 * 10 ** 12 // (256 << 20))
    assert big["spark.sql.adaptive.advisoryPartitionSizeInBytes"] == str(256 << 20)


def test_distinct_count_in_one_scan(spark):
    from truant.operators.profile import distinct_count
    rows = [(i % 200 - 100, i % 2 == 0, float(i % 3) if i % 7 else None, f"t{i % 11}" if i % 5 else None, -0.0 if i % 2 else 0.0, float("nan"), None) for i in range(500)]
    df = spark.createDataFrame(rows, "a int, b boolean, c double, d string, e double, f double, g int").withColumns({
        "h": F.expr("timestamp_micros(a * 1000003L)"), "i": F.expr("date_add(date'1969-12-30', abs(a) % 9)"), "j": F.expr("a * 123456789012L"),
        "k": F.expr("cast(a % 4 as decimal(9, 2))")})
    want = df.agg(*[F.count_distinct(c).alias(f"n_distinct_{c}") for c in df.columns]).first().asDict()
    got = distinct_count(df)
    assert got.first().asDict() == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") == 1 and "SortAggregate" not in plan and "ObjectHash" not in plan
    assert distinct_count(df.where("false")).first().asDict() == dict.fromkeys(want, 0)
