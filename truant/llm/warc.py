"""Content-addressed WARC archive: payloads stored once, headers apart, records rebuilt by joins.

An archive is a folder with two Parquet tables:

* ``payloads`` (digest, payload): each payload's bytes once, under their
  SHA-256;
* ``headers`` (page_id, digest, copies, header): the exact header block of each
  WARC/1.1 record.

Of the records with equal payloads that with the least page_id is a response,
the others are revisits that refer to it.  On writing, payloads of one SHA-256
must agree in length and SHA-1 as well; on reading, every stored payload is
hashed again and must give its own name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from truant.llm._common import keyed_join, written

#: So many records share one copy of their payload when records are rebuilt.
RECORDS_A_COPY = 64
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HEADERS = "page_id long, digest binary, copies long, header binary"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: 40 bits at a time make 8 digits."""
    sha = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(sha, i, 10), 16, 32), 8, "0") for i in range(1, 41, 10)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _payloads(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    return pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), payload.alias("payload")).withColumn(
        "digest", F.unhex(F.sha2("payload", 256)))


def _header(date: str) -> Column:
    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))

    revisit = F.col("refers_to").isNotNull()
    uri = F.regexp_replace(F.regexp_replace(F.col("url"), "\r", "%0D"), "\n", "%0A")
    return F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">"))),
        F.coalesce(line("WARC-Target-URI", uri), F.lit("")),
        line("WARC-Date", F.lit(date)),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        line("WARC-Payload-Length", F.col("size").cast("string")),
        F.coalesce(line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("refers_to").cast("string"), F.lit(">"))), F.lit("")),
        F.when(revisit, line("WARC-Profile", F.lit(PROFILE))).otherwise(F.lit("")),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("size").cast("string"))),
        F.lit("\r\n"),
    ).cast("binary")


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                  min_bytes: int = 0, date: str = DATE) -> None:
    """Write one record per row of ``pages`` to the archive folder ``path``.

    A null html is an empty payload; a null url gives a record without target.
    Payloads under ``min_bytes`` are all responses (their bytes are still stored
    once).  Repeated rows are repeated records, each a response if its id is the
    least; records with a null id are responses, and the least id is taken from
    the others.  An empty table gives an empty archive.
    """
    meta = _payloads(pages, id_col, url_col, html_col).select(
        "page_id", "url", "digest", base32_sha1(F.col("payload")).alias("sha1"), F.octet_length("payload").cast("long").alias("size"))
    meta = written(meta, "warc-meta")
    groups = written(meta.groupBy("digest").agg(
        F.min("page_id").alias("first_id"), F.count("*").alias("copies"),
        (F.min("size") != F.max("size")).alias("sizes_differ"), (F.min("sha1") != F.max("sha1")).alias("sha1_differ")), "warc-groups")
    if groups.filter("sizes_differ or sha1_differ").head(1):
        raise ValueError("different payloads share a SHA-256")
    groups = groups.select("digest", "first_id", "copies")
    refers = F.when((F.col("page_id") != F.col("first_id")) & (F.col("size") >= min_bytes), F.col("first_id"))
    records = keyed_join(meta, groups, ["digest"], "copies").withColumn("refers_to", refers)
    records.select("page_id", "digest", "copies", _header(date).alias("header")).write.option("compression", "zstd").parquet(f"{path}/headers")

    rows = _payloads(pages, id_col, url_col, html_col).select("page_id", "digest", "payload")
    first = rows.join(groups.select("digest", F.col("first_id").alias("page_id")), ["page_id", "digest"])  # an id is no hot key
    once = first.withColumn("nth", F.row_number().over(Window.partitionBy("page_id", "digest").orderBy("page_id")))
    once.filter("nth = 1").select("digest", "payload").write.option("compression", "zstd").parquet(f"{path}/payloads")
    if groups.filter("first_id is null").head(1):  # payloads of records without an id only
        lone = rows.join(groups.filter("first_id is null").select("digest"), "digest", "left_semi")
        lone.groupBy("digest").agg(F.any_value("payload").alias("payload")).write.mode("append").option("compression", "zstd").parquet(f"{path}/payloads")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, header, payload) of every record, with the full payload also for revisits.

    Fails if a stored payload doesn't hash to its name, or if the length or
    SHA-1 in a record's header isn't its payload's.
    """
    headers = spark.read.schema(HEADERS).parquet(f"{path}/headers")
    stored = spark.read.schema("digest binary, payload binary").parquet(f"{path}/payloads")
    stored = stored.withColumn("payload", F.when(F.unhex(F.sha2("payload", 256)) == F.col("digest"), F.col("payload")).otherwise(
        F.raise_error("a stored payload doesn't match its digest").cast("binary")))
    spread = F.ceil(F.col("copies") / RECORDS_A_COPY)
    rows = headers.withColumn("salt", F.pmod(F.xxhash64("page_id"), spread))
    copies = written(headers.groupBy("digest").agg(F.max("copies").alias("copies")).filter(F.col("copies") > RECORDS_A_COPY), "warc-copies")
    salts = stored.join(copies, "digest", "left").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce(spread, F.lit(1)) - 1))).drop("copies")
    records = rows.join(salts, ["digest", "salt"]).select("page_id", "header", "payload")
    right = (header_field("WARC-Payload-Length") == F.octet_length("payload").cast("string")) & (
        header_field("WARC-Payload-Digest") == F.concat(F.lit("sha1:"), base32_sha1(F.col("payload"))))
    return records.withColumn("payload", F.when(right, F.col("payload")).otherwise(
        F.raise_error("a record's payload doesn't match its header").cast("binary")))


def header_field(name: str) -> Column:
    """The value of a field of the column ``header``; null if it isn't there."""
    value = F.regexp_extract(F.decode("header", "UTF-8"), f"\r\n{name}: ([^\r\n]*)", 1)
    return F.when(value != "", value)


def record_bytes() -> Column:
    """The bytes of a record as a WARC file has them; a revisit's block is empty."""
    block = F.when(header_field("WARC-Type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    return F.concat(F.col("header"), block, F.lit(b"\r\n\r\n"))


def describe(records: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to), lengths and digests of the rebuilt payloads."""
    number = F.regexp_extract(F.coalesce(header_field("WARC-Refers-To"), F.lit("")), r"<urn:page:(-?\d+)>", 1)
    return records.select(
        "page_id", F.octet_length("payload").cast("long").alias("payload_bytes"), base32_sha1(F.col("payload")).alias("payload_digest"),
        header_field("WARC-Type").alias("record_type"), F.when(number != "", number).cast("long").alias("refers_to"))
