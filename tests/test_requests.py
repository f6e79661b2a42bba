"""Request envelopes: round trip and the side output for bad lines."""

import json

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from truant.fixtures import appointments
from truant.sources import requests, tables


def test_round_trip_keeps_all_rows(spark):
    a = appointments(spark, SF_SMALL)
    req = requests.encode_requests(a, F.floor(F.col("APPOINTMENTID") / 50).cast("long"))
    back = requests.decode_requests(req)
    assert back.exceptAll(a).count() == 0 and a.exceptAll(back).count() == 0


def _request(spark, *bodies):
    return spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "request_id long, body string")


def _data(text):
    return json.dumps({"data": text})


def test_every_request_is_answered_or_explained(spark):
    head = "PATIENTID,APPOINTMENTID,GENDER,SCHEDULEDDAY,AGE"
    req = _request(
        spark, _data(f"{head}\n1.0,7,F,2016-04-29T18:38:08Z,62\n\n2.0,x,F,2016-04-29,1\n3.0,9,M\n4.0,,M,2016-04-29,2"),
        "not json", '{"x": 1}', None, _data(""), _data(head), _data("PATIENTID,AGE\n1.0,3"), _data(f"{head}\n1.0,8,F,someday,5"))
    rows = requests.parse_requests(req).orderBy("request_id", "line_no").collect()
    assert {r.request_id for r in rows} == set(range(8))
    assert [(r.request_id, r.line_no, r.error) for r in rows if r.request_id == 0] == [
        (0, 1, None), (0, 3, "APPOINTMENTID can't be read: x"), (0, 4, "not as many fields as the header"), (0, 5, "no APPOINTMENTID")]
    by_id = {r.request_id: r.error for r in rows if r.request_id}
    assert by_id[1] == by_id[2] == by_id[3] == "the body has no text under data"
    assert by_id[4] == by_id[6] == "the header has no APPOINTMENTID" and by_id[5] == "no lines" and by_id[7] == "SCHEDULEDDAY can't be read: someday"
    good = requests.decode_requests(req, keep_id=True).collect()
    assert len(good) == 1 and good[0].AGE == 62 and good[0].SCHEDULEDDAY is not None
    assert len(good) + requests.decode_errors(req).count() == len(rows)


def test_header_decides_and_quotes_hold_line_breaks(spark):
    text = 'AGE,Handcap,NEIGHBOURHOOD,APPOINTMENTID,PATIENTID\r\n40,1,"North,\nof ""here""",7,70\r\n41,0,Plain,8,80\r\n'
    rows = requests.decode_requests(_request(spark, _data(text))).orderBy("APPOINTMENTID").collect()
    assert [(r.APPOINTMENTID, r.PATIENTID, r.AGE, r.HANDICAP) for r in rows] == [(7, 70.0, 40, 1), (8, 80.0, 41, 0)]
    assert rows[0].NEIGHBOURHOOD == 'North,\nof "here"'


def test_quoted_values_survive_the_round_trip(spark):
    a = appointments(spark, SF_SMALL).limit(5).withColumn("NEIGHBOURHOOD", F.lit('a "b",\nc'))
    req = requests.encode_requests(a, F.lit(1))
    assert requests.decode_requests(req).select(a.columns).exceptAll(a).count() == 0 and requests.decode_requests(req).count() == 5


def test_responses_per_request(spark):
    pred = spark.createDataFrame([(1, 10, 0), (1, 9, 1), (2, 11, 1)], "request_id long, APPOINTMENTID long, PREDICTED_NO_SHOW int")
    got = {r.request_id: json.loads(r.response)["predictions"] for r in requests.encode_responses(pred, "request_id").collect()}
    assert [p["APPOINTMENTID"] for p in got[1]] == [9, 10] and len(got[2]) == 1


@pytest.mark.parametrize("text", ["2016-04-29T18:38:08Z", "2016-04-29 18:38:08+00:00", "2016-04-29 18:38:08", "2016-04-29T18:38:08.000000Z", "2016-04-29T20:38:08+02:00"])
def test_times_in_usual_spellings(spark, tmp_path, text):
    (tmp_path / "a.csv").write_text(f"AppointmentID,ScheduledDay,PatientId,Age\n5,{text},2.9872499824296E13,62.0\n")
    r = tables.scan_csv(spark, str(tmp_path)).first()
    assert r.SCHEDULEDDAY.isoformat(sep=" ") == "2016-04-29 18:38:08" and r.APPOINTMENTID == 5 and r.AGE == 62 and r.PATIENTID == 2.9872499824296e13


def test_bad_csv_lines_are_kept_apart(spark, tmp_path):
    (tmp_path / "a.csv").write_text("APPOINTMENTID,AGE\n1,20\n2,old\n3\n,4\n5,6,7\n8,\n")
    assert [(r.APPOINTMENTID, r.AGE) for r in tables.scan_csv(spark, str(tmp_path)).orderBy("APPOINTMENTID").collect()] == [(1, 20), (8, None)]
    errors = {r.line: r.error for r in tables.csv_errors(spark, str(tmp_path)).collect()}
    assert errors["2,old"] == "AGE can't be read: old" and errors[",4"] == "no APPOINTMENTID" and len(errors) == 4


def test_quoted_line_break_in_a_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text('APPOINTMENTID,NEIGHBOURHOOD\n1,"x\ny"\n2,z\n')
    rows = tables.scan_csv(spark, str(tmp_path), multi_line=True).orderBy("APPOINTMENTID").collect()
    assert [r.NEIGHBOURHOOD for r in rows] == ["x\ny", "z"]


def test_any_number_of_columns_and_quoted_fields(spark):
    """A body with 300 columns, the key last; quotes, commas and line breaks in fields; a short line is an error row."""
    import json

    from truant.sources import requests
    names = [f"X{i}" for i in range(299)] + ["APPOINTMENTID"]
    line = ",".join(['"a,""b""\nc"', *["x"] * 298, "7"])
    wide = json.dumps({"data": ",".join(names) + "\n" + line + "\n" + "1,2,3"})
    some = json.dumps({"data": 'NEIGHBOURHOOD,"AGE",APPOINTMENTID,GENDER\n"Sant"" Ana, ""S""",41,8,\n"",,9,"F"'})
    req = spark.createDataFrame([(1, wide), (2, some)], "request_id long, body string")
    good = {r.APPOINTMENTID: r for r in requests.decode_requests(req, keep_id=True).collect()}
    assert sorted(good) == [7, 8, 9]
    assert (good[8].NEIGHBOURHOOD, good[8].AGE, good[8].GENDER) == ('Sant" Ana, "S"', 41, None)
    assert (good[9].NEIGHBOURHOOD, good[9].AGE, good[9].GENDER) == (None, None, "F")
    assert [(r.request_id, r.error) for r in requests.decode_errors(req).collect()] == [(1, "not as many fields as the header")]
