"""Registered queries: table DDL, CSV/Parquet round trips, JSON, request
envelopes, patient history windows and the stream scorers."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from truant.fixtures import appointments, table, with_ctes
from truant.operators import clean, history
from truant.plans.catalog import query
from truant.plans.catalog_models import SCORED_SQL, _checked, _quick, _unlabelled
from truant.plans.oracle_sql import PREPROCESSED_SQL
from truant.schema import COLUMNS, KEY
from truant.session import scratch_path as _scratch
from truant.session import spread
from truant.sources import requests, tables
from truant.streaming import history as stream_history
from truant.streaming import score as stream

_ALL = with_ctes("SELECT * FROM appointments")


@query("create_table", _ALL)
def q_create_table(spark, sf):
    """CREATE DATABASE / TABLE with the declared 14 columns, load, read back."""
    loc = _scratch(spark, "appointment_data")
    name = tables.create_table(spark, "appointment_data_" + uuid.uuid4().hex[:8], "truant_db", loc)
    appointments(spark, sf).select(*COLUMNS).write.insertInto(name)
    return tables.scan_table(spark, name)


@query("cache_full", _ALL)
def q_cache_full(spark, sf):
    return tables.cache_full(appointments(spark, sf), _scratch(spark, "full"))


@query("csv_roundtrip", _ALL)
def q_csv_roundtrip(spark, sf):
    """write_csv then scan_csv with the declared schema: microsecond
    timestamps survive, so waiting days are unchanged."""
    path = _scratch(spark, "csv")
    tables.write_csv(appointments(spark, sf), path)
    return tables.scan_csv(spark, path)


def _as_text(a, pattern: str, suffix: str = ""):
    """Appointments with their two times as texts of one spelling, to the second."""
    def spelled(c):
        return F.concat(F.date_format(c, pattern), F.lit(suffix)).alias(c)
    return a.select(*[spelled(c) if c in ("SCHEDULEDDAY", "APPOINTMENTDAY") else F.col(c) for c in a.columns])


_SECONDS = with_ctes("SELECT * REPLACE (date_trunc('second', SCHEDULEDDAY) AS SCHEDULEDDAY, date_trunc('second', APPOINTMENTDAY) AS APPOINTMENTDAY)"
                     " FROM appointments")


@query("csv_iso_seconds", _SECONDS)
def q_csv_iso_seconds(spark, sf):
    """Times like 2016-04-29T18:38:08Z, and the header as the public file spells it."""
    path = _scratch(spark, "csv-iso")
    a = _as_text(appointments(spark, sf), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    a = a.withColumnsRenamed({"HYPERTENSION": "Hipertension", "HANDICAP": "Handcap", "NO_SHOW": "No-show", "PATIENTID": "PatientId"})
    tables.write_csv(a, path)
    return tables.scan_csv(spark, path)


@query("csv_blank_offset", _SECONDS)
def q_csv_blank_offset(spark, sf):
    """Times like 2016-04-27 18:38:08+00:00, columns in another order, one unknown column."""
    path = _scratch(spark, "csv-offset")
    a = _as_text(appointments(spark, sf), "yyyy-MM-dd HH:mm:ss", "+00:00")
    tables.write_csv(a.select(*reversed(a.columns), F.lit("x").alias("EXTRA")), path)
    return tables.scan_csv(spark, path)


_BAD = "APPOINTMENTID % 9 = 4"


@query("csv_bad_lines", with_ctes(
    f"SELECT CASE WHEN {_BAD} THEN 'bad' ELSE 'good' END AS kind, CAST(COUNT(*) AS BIGINT) AS n FROM appointments GROUP BY 1"))
def q_csv_bad_lines(spark, sf):
    """A ninth of the lines has an unreadable age: rows in = rows out + error rows."""
    path = _scratch(spark, "csv-bad")
    a = appointments(spark, sf)
    tables.write_csv(a.withColumn("AGE", F.when(F.expr(_BAD), F.lit("forty")).otherwise(F.col("AGE").cast("string"))), path)
    kinds = tables.scan_csv(spark, path).select(F.lit("good").alias("kind")).union(tables.csv_errors(spark, path).select(F.lit("bad")))
    return kinds.groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


@query("json_get", with_ctes(
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events"))
def q_json_get(spark, sf):
    ev = table(spark, sf, "events")
    return ev.select("event_id", requests.json_get("props", "$.k").cast("int").alias("k"))


def _batch():
    """At most 100 rows per request body."""
    return F.floor(F.col(KEY) / 100).cast("long")


_BODY_LINE = ("concat_ws(',', CAST(PATIENTID AS VARCHAR), APPOINTMENTID, GENDER, strftime(SCHEDULEDDAY, '%Y-%m-%dT%H:%M:%S.%fZ'),"
              " strftime(APPOINTMENTDAY, '%Y-%m-%dT%H:%M:%S.%fZ'), AGE, NEIGHBOURHOOD, SCHOLARSHIP, HYPERTENSION, DIABETES, ALCOHOLISM,"
              " HANDICAP, SMS_RECEIVED, NO_SHOW)")


@query("encode_requests", with_ctes(
    f"SELECT CAST(floor(APPOINTMENTID / 100) AS BIGINT) AS request_id, '{{\"data\":\"{','.join(COLUMNS)}\\n' ||"
    f" string_agg({_BODY_LINE}, '\\n' ORDER BY {_BODY_LINE}) || '\"}}' AS body FROM appointments GROUP BY 1"))
def q_encode_requests(spark, sf):
    return requests.encode_requests(appointments(spark, sf), _batch())


@query("decode_requests", _ALL)
def q_decode_requests(spark, sf):
    """Round trip: rows -> request bodies -> rows, nothing lost or changed."""
    req = requests.encode_requests(appointments(spark, sf), _batch())
    return requests.decode_requests(req)


@query("requests_reordered", _ALL)
def q_requests_reordered(spark, sf):
    """Every second request has its columns in reverse order: the header decides."""
    a = appointments(spark, sf)
    odd = _batch() % 2 == 1
    req = requests.encode_requests(a.where(~odd), _batch()).union(
        requests.encode_requests(a.where(odd), _batch(), list(reversed(a.columns))))
    return requests.decode_requests(req)


@query("requests_bad_bodies", with_ctes(
    "SELECT request_id, CAST(CASE WHEN request_id % 5 < 3 THEN 0 ELSE n END AS BIGINT) AS rows_out,"
    " CASE request_id % 5 WHEN 0 THEN 'the body has no text under data' WHEN 1 THEN 'the body has no text under data'"
    " WHEN 2 THEN 'the header has no APPOINTMENTID' END AS error"
    " FROM (SELECT CAST(floor(APPOINTMENTID / 100) AS BIGINT) AS request_id, COUNT(*) AS n FROM appointments GROUP BY 1) t"))
def q_requests_bad_bodies(spark, sf):
    """Of five requests one isn't JSON, one has no data and one no key column: each has its error row."""
    req = requests.encode_requests(appointments(spark, sf), _batch())
    kind = F.col("request_id") % 5
    keyless = F.replace("body", F.lit("APPOINTMENTID"), F.lit("OTHER"))
    body = F.when(kind == 0, F.lit("not json")).when(kind == 1, F.lit('{"x":1}')).when(kind == 2, keyless).otherwise(F.col("body"))
    rows = requests.parse_requests(req.withColumn("body", body))
    return rows.groupBy("request_id").agg(F.count_if(F.col("error").isNull()).alias("rows_out"), F.max("error").alias("error"))


@query("encode_responses", with_ctes(
    "SELECT APPOINTMENTID, json_object('APPOINTMENTID', APPOINTMENTID,"
    " 'PREDICTED_NO_SHOW', CAST(CASE NO_SHOW WHEN 'Yes' THEN 1 ELSE 0 END AS INT))::VARCHAR AS response"
    " FROM appointments"))
def q_encode_responses(spark, sf):
    a = appointments(spark, sf).select(KEY, F.when(F.col("NO_SHOW") == "Yes", 1).otherwise(0)
                                       .alias("PREDICTED_NO_SHOW"))
    return requests.encode_responses(a)


@query("prior_appointments", with_ctes(
    "SELECT APPOINTMENTID, PATIENTID, CAST(COUNT(*) OVER (PARTITION BY PATIENTID ORDER BY SCHEDULEDDAY,"
    " APPOINTMENTID ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT) AS prior_appointments"
    " FROM appointments"))
def q_prior_appointments(spark, sf):
    a = appointments(spark, sf).select(KEY, "PATIENTID", "SCHEDULEDDAY")
    return history.prior_appointments(a).select(KEY, "PATIENTID", "prior_appointments")


_NULL_PATIENT = "SELECT CASE WHEN APPOINTMENTID % 6 <> 1 THEN PATIENTID END AS PATIENTID, * EXCLUDE (PATIENTID) FROM appointments"


@query("history_null_patient", with_ctes(
    "SELECT a.APPOINTMENTID, CASE WHEN a.PATIENTID IS NULL THEN 0 ELSE CAST(COUNT(*) OVER (PARTITION BY a.PATIENTID ORDER BY a.SCHEDULEDDAY,"
    " a.APPOINTMENTID ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT) END AS prior_appointments,"
    " CAST((SELECT COUNT(*) FROM np b WHERE b.PATIENTID = a.PATIENTID AND b.APPOINTMENTID <> a.APPOINTMENTID"
    " AND b.APPOINTMENTDAY < a.SCHEDULEDDAY) AS BIGINT) AS prior_known FROM np a", np=_NULL_PATIENT))
def q_history_null_patient(spark, sf):
    """A sixth of the rows has no patient: they have no history, and none is lost."""
    a = clean.encode_target(appointments(spark, sf)).withColumn("PATIENTID", F.when(F.col(KEY) % 6 != 1, F.col("PATIENTID")))
    a = a.select(KEY, "PATIENTID", "SCHEDULEDDAY", "APPOINTMENTDAY", "NO_SHOW")
    return history.prior_misses(history.prior_appointments(a)).select(KEY, "prior_appointments", "prior_known")


@query("prior_misses", with_ctes(
    "SELECT a.APPOINTMENTID, a.PATIENTID,"
    " CAST(COUNT(b.APPOINTMENTID) AS BIGINT) AS prior_known,"
    " CAST(COALESCE(SUM(b.NO_SHOW), 0) AS BIGINT) AS prior_misses"
    " FROM p a LEFT JOIN p b ON b.PATIENTID = a.PATIENTID AND b.APPOINTMENTID <> a.APPOINTMENTID"
    " AND b.APPOINTMENTDAY < a.SCHEDULEDDAY GROUP BY 1, 2",
    p=PREPROCESSED_SQL.replace("SELECT APPOINTMENTID,", "SELECT APPOINTMENTID, PATIENTID,")))
def q_prior_misses(spark, sf):
    a = appointments(spark, sf)
    pre = clean.encode_target(a).filter(clean.valid_dates()).filter(F.col("AGE") >= 0)
    out = history.prior_misses(pre.select(KEY, "PATIENTID", "SCHEDULEDDAY", "APPOINTMENTDAY", "NO_SHOW"))
    return out.select(KEY, "PATIENTID", "prior_known", "prior_misses")


@query("score_stream", SCORED_SQL)
def q_score_stream(spark, sf):
    """Unlabelled rows written as CSV files, scored by a file stream
    (availableNow trigger) with the frozen state; the sink is read back."""
    t = _quick(spark, sf)
    src, out, ck = _scratch(spark, "in"), _scratch(spark, "out"), _scratch(spark, "ck")
    tables.write_csv(spread(_unlabelled(spark, sf), t.predictions.count(), least=1), src)  # about as many rows as were tested
    stream.score_stream(spark, src, t.prepared.state, t.model, out, ck)
    return _checked(spark.read.parquet(out))


@query("score_requests_stream", SCORED_SQL.replace("SELECT APPOINTMENTID, 1", "SELECT CAST(floor(APPOINTMENTID / 100) AS BIGINT) AS request_id, APPOINTMENTID, 1"))
def q_score_requests_stream(spark, sf):
    """Request envelopes (JSON lines) scored by a stream, with the request each row answers."""
    t = _quick(spark, sf)
    src, out, ck = (_scratch(spark, n) for n in ("req", "rout", "rck"))
    req = requests.encode_requests(_unlabelled(spark, sf), _batch())
    req.write.json(src)
    stream.score_requests_stream(spark, src, t.prepared.state, t.model, out, ck)
    return _checked(spark.read.parquet(out), "request_id")


@query("parse_timestamp", with_ctes(
    "SELECT APPOINTMENTID, SCHEDULEDDAY AS parsed, CAST(NULL AS TIMESTAMP) AS bad FROM appointments"))
def q_parse_timestamp(spark, sf):
    """Timestamp text parsed back (microseconds kept); unparseable text -> null."""
    from truant.functions.dates import parse_timestamp
    a = appointments(spark, sf)
    txt = F.date_format("SCHEDULEDDAY", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return a.select(KEY, parse_timestamp(txt, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("parsed"),
                    parse_timestamp(F.concat(F.lit("x"), txt), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("bad"))


@query("history_stream", with_ctes(
    "SELECT a.APPOINTMENTID, a.PATIENTID, CAST((SELECT COUNT(*) FROM t b WHERE b.PATIENTID = a.PATIENTID"
    " AND (b.SCHEDULEDDAY, b.APPOINTMENTID) < (a.SCHEDULEDDAY, a.APPOINTMENTID)) AS BIGINT) AS prior_appointments,"
    " CAST(COUNT(b.APPOINTMENTID) AS BIGINT) AS prior_known, CAST(COALESCE(SUM(b.NO_SHOW), 0) AS BIGINT) AS prior_misses"
    " FROM t a LEFT JOIN t b ON b.PATIENTID = a.PATIENTID AND b.APPOINTMENTID <> a.APPOINTMENTID AND b.APPOINTMENTDAY < a.SCHEDULEDDAY"
    " GROUP BY ALL", t="SELECT * REPLACE (CAST(CASE NO_SHOW WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END AS INT) AS NO_SHOW) FROM appointments"))
def q_history_stream(spark, sf):
    """Histories on a stream: the earlier and the later half of the appointments arrive one after the other, then the end."""
    a = clean.encode_target(appointments(spark, sf)).select(KEY, "PATIENTID", "SCHEDULEDDAY", "APPOINTMENTDAY", "NO_SHOW")
    src, out, ck = (_scratch(spark, n) for n in ("arrivals", "histories", "histories-ck"))
    middle = a.agg(F.percentile_approx(F.unix_micros("SCHEDULEDDAY"), 0.5)).scalar()
    early = F.unix_micros("SCHEDULEDDAY") < middle
    for number, part in enumerate((a.where(early), a.where(~early), stream_history.end_row(spark, a))):
        part.write.parquet(f"{src}/part={number}")
    for number in range(3):  # what has arrived so far, each time
        arrived = spark.readStream.schema(a.schema).parquet(f"{src}/part=[0-{number}]")
        stream_history.history_stream(arrived, out, ck)
    return spark.read.parquet(out).select(KEY, "PATIENTID", "prior_appointments", "prior_known", "prior_misses")
