"""The queries opN_<name> and their DuckDB texts."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from truant.llm import blockrank, collocations, decontaminate, iblt, langid, line_dedup, packing, quality, simhash, suffix_tree, topk, url_filter, warc
from truant.llm._common import id_crc_mod, new_folder, table
from truant.llm.oracles import OP1, OP5, OP7, OP9, OP11, OP12, OP13, url_sql

TOKENIZER = "byte_bpe_50k"
#: The rules that the query applies.
RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items contained in documents, to 80 % of their 5-word shingles."""
    return decontaminate.contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), shingle=5, threshold=0.8)


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on all page urls: rules, else path templates labelled by the rules."""
    return url_filter.verdicts(table(spark, sf_dir, "pages"), RULES).withColumn("purity", F.round("purity", 6))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(f"{TOKENIZER}.json"),
                        public_tokenizers.path(f"{TOKENIZER}.tiktoken"), public_tokenizers.PATTERN, length=2048)


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents, learned from the rows that aren't held out."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.coalesce(id_crc_mod(F.col("doc_id"), 5) == 0, F.lit(False))
    model = quality.fit(docs.filter(~held_out), labels.filter(~held_out))
    scored = docs.select("doc_id", held_out.alias("held_out"), model.score(F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op5_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to a content-addressed archive and read back."""
    path = new_folder(spark, "warc")
    warc.write_archive(table(spark, sf_dir, "pages"), path, min_bytes=0)
    return warc.describe(warc.read_archive(spark, path))


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """3-word SimHash fingerprints of all documents, linked at two bits or fewer."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=2).select(
        "doc_id", "fingerprint", "component_id")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the lines that a smaller doc_id holds."""
    docs = table(spark, sf_dir, "documents")
    return line_dedup.dedup(docs, min_chars=10).apply(docs).select(
        "doc_id", "kept.n_lines", "kept.n_dropped", F.sha2("kept.text", 256).alias("kept_sha256"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents, learned from the rows that aren't held out."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(id_crc_mod(F.col("doc_id"), 4) == 2, F.lit(False))
    model = langid.fit(docs.filter(~held_out))
    rows = langid.predict(docs.select("doc_id", "text", held_out.alias("held_out")), model, F.col("text"))
    return rows.select("doc_id", "held_out", F.col("language.lang").alias("lang_pred"), F.col("language.score").alias("score"))


def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best inner products of each hundredth vector with all others."""
    return topk.search(table(spark, sf_dir, "embeddings"), "vec_id % 100 = 0", k=10)


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suffix tree scores of all documents, learned from the rows that aren't held out."""
    docs = table(spark, sf_dir, "documents")
    return suffix_tree.score_documents(docs, id_crc_mod(F.col("doc_id"), 10) == 0)


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of each benchmark item."""
    return blockrank.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=20)


def op12_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of all documents and of their edited texts, compared."""
    return iblt.fingerprints(table(spark, sf_dir, "documents"))


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 phrases of 2 to 5 words of each language."""
    return collocations.collocations(table(spark, sf_dir, "documents"), min_count=100, max_words=5, top=2000)


QUERIES = {
    "op1_benchmark_decontamination": op1_benchmark_decontamination,
    "op2_url_filter": op2_url_filter,
    "op3_packing": op3_packing,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_warc_archive": op5_warc_archive,
    "op6_simhash_near_dedup": op6_simhash_near_dedup,
    "op7_line_dedup": op7_line_dedup,
    "op8_language_id": op8_language_id,
    "op9_exact_top_k": op9_exact_top_k,
    "op10_lm_scoring": op10_lm_scoring,
    "op11_ranked_search": op11_ranked_search,
    "op12_document_fingerprints": op12_document_fingerprints,
    "op13_phrase_collocations": op13_phrase_collocations,
}

ORACLE = {
    "op1_benchmark_decontamination": OP1,
    "op2_url_filter": url_sql(RULES),
    "op5_warc_archive": OP5,
    "op7_line_dedup": OP7,
    "op9_exact_top_k": OP9,
    "op11_ranked_search": OP11,
    "op12_document_fingerprints": OP12,
    "op13_phrase_collocations": OP13,
}
