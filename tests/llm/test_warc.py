import base64
import hashlib
import re

import pytest

from truant.llm import warc

SCHEMA = "page_id long, url string, html string"
ROWS = [(3, "http://a/ü", "<p>é</p>"), (1, "http://b/\r\nWARC-Type: fake", "<p>é</p>"), (2, None, None), (4, "", ""), (5, "u", "tiny"), (6, "u", "tiny"),
        (7, "v", "x\r\n\r\nWARC/1.1\r\n" * 9_000), (1, "http://b", "<p>é</p>"), (None, "w", "only without an id"), (None, "w", "only without an id"),
        (None, "w", "tiny"), (8, "z", "漢" * 100), (9, "z", "漢" * 100)]
ROWS += [(100 + i, f"http://h/{i}", "a large group of copies") for i in range(300)]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as digest", "2 as copies", "'s' as sha1")


def read(spark, rows, path, **options):
    warc.write_archive(frame(spark, rows), path, **options)
    return warc.read_archive(spark, path)


def expected(rows, min_bytes=0):
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    out = []
    for i, _, h in rows:
        raw = (h or "").encode()
        revisit = i is not None and i != first[h or ""] and len(raw) >= min_bytes
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        out.append((i, len(raw), digest, "revisit" if revisit else "response", first[h or ""] if revisit else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("min_bytes", [0, 5])
def test_round_trip(llm_spark, tmp_path, min_bytes):
    records = read(llm_spark, ROWS, f"{tmp_path}/a", min_bytes=min_bytes)
    assert sorted((tuple(r) for r in warc.describe(records).collect()), key=repr) == expected(ROWS, min_bytes)
    payloads = sorted(((r.page_id, bytes(r.payload)) for r in records.collect()), key=repr)
    assert payloads == sorted(((i, (h or "").encode()) for i, _, h in ROWS), key=repr)
    stored = llm_spark.read.parquet(f"{tmp_path}/a/payloads")
    assert stored.count() == stored.select("digest").distinct().count() == len({h or "" for _, _, h in ROWS})


def test_records_are_valid_warc(llm_spark, tmp_path):
    records = read(llm_spark, ROWS, f"{tmp_path}/a")
    for r in records.select("page_id", warc.record_bytes().alias("raw")).collect():
        head, _, rest = bytes(r.raw).partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        assert lines[0] == "WARC/1.1" and all(re.match(r"[\w-]+: ", x) for x in lines[1:])
        fields = dict(x.split(": ", 1) for x in lines[1:])
        assert rest[int(fields["Content-Length"]) :] == b"\r\n\r\n"


def test_empty_table(llm_spark, tmp_path):
    assert warc.describe(read(llm_spark, [], f"{tmp_path}/a")).count() == 0


def test_a_spoilt_payload_is_noticed(llm_spark, tmp_path):
    warc.write_archive(frame(llm_spark, ROWS[:3]), f"{tmp_path}/a")
    from pyspark.sql import functions as F

    spoilt = llm_spark.read.parquet(f"{tmp_path}/a/payloads").withColumn("payload", F.concat("payload", F.lit(b"!"))).collect()
    llm_spark.createDataFrame(spoilt, "digest binary, payload binary").write.mode("overwrite").parquet(f"{tmp_path}/a/payloads")
    with pytest.raises(Exception, match="doesn't match its digest"):
        warc.describe(warc.read_archive(llm_spark, f"{tmp_path}/a")).collect()
