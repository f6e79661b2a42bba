"""Structured Streaming scorers: files (or request bodies) arriving over time
are scored with the frozen feature state and model.

Only stateless steps run on the stream: typing, cleaning, projections, a
broadcast lookup of the static encoding table and ``model.transform``.
Everything data-dependent was fixed at training time (a distinct count or a
category list cannot be computed on an unbounded stream).

A stream is one query.  Each micro-batch is decoded once, and written by its
number, so a batch that is run again after a failure replaces its own output:
scored rows to the output folder, and whatever couldn't be scored, with its
reason, to the errors folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from truant.operators import clean
from truant.plans.scoring import score_frame
from truant.schema import KEY
from truant.sources.requests import parse_requests
from truant.sources.tables import read_csv_stream

REQUEST_SCHEMA = T.StructType([T.StructField("request_id", T.LongType()),
                               T.StructField("body", T.StringType())])


def _run(stream: DataFrame, parse, state, model, output_dir: str, errors_dir: str, checkpoint_dir: str,
         keep: list[str], available_now: bool, processing_time: str | None):
    def batch(df: DataFrame, number: int) -> None:
        rows = parse(df).persist()
        try:
            reject = F.when(~clean.usable(), F.lit("rejected by the cleaning rules"))
            rows = rows.withColumn("error", F.coalesce("error", reject))
            good = rows.where("error is null")
            scored = score_frame(good.drop("line", "error"), state, model, stamp_col=None, keep=keep)
            scored.write.mode("overwrite").parquet(f"{output_dir}/batch={number}")
            rows.where("error is not null").select(*keep, KEY, "line", "error").write.mode("overwrite").parquet(f"{errors_dir}/batch={number}")
        finally:
            rows.unpersist()

    w = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint_dir)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "1 minute")
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q


def score_stream(spark: SparkSession, input_dir: str, state, model, output_dir: str, checkpoint_dir: str,
                 errors_dir: str | None = None, available_now: bool = True, columns: list[str] | None = None,
                 processing_time: str | None = None):
    """CSV files of unlabelled appointments -> scored rows; lines that can't
    be read or used go to ``errors_dir`` (default: ``<output>_errors``)."""
    return _run(read_csv_stream(spark, input_dir, columns=columns), lambda df: df, state, model, output_dir,
                errors_dir or f"{output_dir}_errors", checkpoint_dir, [], available_now, processing_time)


def score_requests_stream(spark: SparkSession, input_dir: str, state, model, output_dir: str,
                          checkpoint_dir: str, errors_dir: str | None = None, available_now: bool = True,
                          processing_time: str | None = None):
    """JSON-lines files of ``{"request_id", "body"}`` -> scored rows with their
    request id and line number (``requests.encode_responses(..., "request_id")``
    answers them); lines and bodies that can't be used go to ``errors_dir``."""
    req = spark.readStream.schema(REQUEST_SCHEMA).json(input_dir)
    return _run(req, parse_requests, state, model, output_dir, errors_dir or f"{output_dir}_errors", checkpoint_dir,
                ["request_id", "line_no"], available_now, processing_time)
