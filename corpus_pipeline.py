"""From raw documents to packed token sequences, stage by stage."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from truant.llm import decontaminate, line_dedup, packing, quality, simhash
from truant.llm._common import id_crc_mod, table, written

#: Documents under this score are rejected.
MIN_QUALITY = 0.3
TOKENIZER = "byte_bpe_50k"


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject; it learns from the labelled rows that aren't held out."""
    learn = F.coalesce(id_crc_mod(F.col("doc_id"), 5) != 0, F.lit(True))
    model = quality.fit(docs.filter(learn), table(spark, sf_dir, "labels").filter(learn))
    return docs.filter(model.score(F.col("text")) >= MIN_QUALITY)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that a smaller doc_id holds; one that loses all its lines is empty."""
    return line_dedup.clean(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays: that with the least id."""
    return simhash.keep_one(docs, shingle=3, max_bits=2)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the sequences that the documents are packed into."""
    return packing.pack(docs, public_tokenizers.path(f"{TOKENIZER}.json"), public_tokenizers.path(f"{TOKENIZER}.tiktoken"), public_tokenizers.PATTERN)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup_stage),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("packing", packing_stage),
]

#: SQL can express neither the compression classifier nor the tokenizer; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each on what its predecessor has written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
