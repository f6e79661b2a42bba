"""Incremental, reversible line dedup: sharded cuckoo filters over exact reference counts.

A line's key is its text without white space at both ends and with A-Z
lower-cased; keys shorter than ``min_chars`` code points are left alone.  The
index keeps, in tables of the shared folder:

* ``refs``: one row (digest, doc_id) per document that holds a key, the exact
  references;
* ``counts``: per digest the number of references and the least document that
  holds it, in generations (the last one counts);
* ``filters``: per shard of digests a cuckoo filter of the digests with
  references.

``insert`` asks the filters first: a digest that its shard's filter does not
know has no old references, so only known ones are looked up in the exact
tables; those without old references, the false positives, get a tag of their
own too.  ``delete`` takes documents out of ``refs``, recounts just the digests
that they held, and builds the filters of the shards in which some have no
references left anew from the counts.  Filters only spare lookups; every
decision comes from the exact tables.

All state is immutable Parquet: a method returns a new index, and the old one
stays valid.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from truant.llm._common import keyed_join, written
from truant.llm.cuckoo import CuckooFilter

MIN_CHARS = 10
#: What a task holds of a shard: its digests in one batch and its filter.
REFS_A_SHARD = 200_000
MIN_SHARDS = 8
STRIP = " \t\n\x0b\x0c\r"
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

REFS = "digest binary, doc_id long"
COUNTS = "digest binary, refs long, owner long, gen int"
FILTERS = "shard int, gen int, filter binary"


def line_digest(line: str, min_chars: int = MIN_CHARS) -> bytes | None:
    """128 bits of the SHA-256 of the line's key; None if the key is too short."""
    key = line.strip(STRIP).translate(_LOWER)
    return hashlib.sha256(key.encode()).digest()[:16] if len(key) >= min_chars else None


def references(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """(digest, doc_id): the distinct keys of each row's lines. Rows with a null id or text give none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            digests, ids = [], []
            for i, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                own = {line_digest(x, min_chars) for x in t.as_py().split("\n")} - {None}
                digests += own
                ids += [i] * len(own)
            yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(ids, pa.int64())], ["digest", "doc_id"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).dropna()
    return rows.mapInArrow(run, REFS)


def _keys(digests: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(x[:8] for x in digests), "<u8")


def _load(filters: pd.DataFrame, capacity: int) -> CuckooFilter:
    return CuckooFilter.loads(bytes(filters["filter"].iloc[0])) if len(filters) else CuckooFilter(capacity)


def _insert_shard(key: tuple, batch: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
    f = _load(filters, 2 * len(batch))
    k = _keys(batch["digest"])
    known = f.contains(k)
    f.insert(k[~known])
    out = batch.assign(known=known, filter=None)[["shard", "digest", "refs", "owner", "known", "filter"]]
    return pd.concat([out, pd.DataFrame([{"shard": key[0], "known": False, "filter": f.dumps()}])], ignore_index=True)


def _add_shard(key: tuple, fresh: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
    f = _load(filters, 2 * len(fresh))
    f.insert(_keys(fresh["digest"]))
    return pd.DataFrame([{"shard": key[0], "filter": f.dumps()}])


def _rebuild_shard(key: tuple, dead: pd.DataFrame, live: pd.DataFrame) -> pd.DataFrame:
    f = CuckooFilter(2 * len(live))
    f.insert(_keys(live["digest"]))
    return pd.DataFrame([{"shard": key[0], "filter": f.dumps()}])


@dataclass(frozen=True)
class LineIndex:
    """References, counts and filters of the lines of all inserted documents."""

    refs: DataFrame
    counts: DataFrame
    filters: DataFrame
    shards: int
    min_chars: int = MIN_CHARS
    gen: int = 0

    @classmethod
    def empty(cls, spark: SparkSession, shards: int = 64, min_chars: int = MIN_CHARS) -> LineIndex:
        """``shards``: choose so that a shard's digests fit a task, see REFS_A_SHARD."""
        return cls(*(spark.createDataFrame([], s) for s in (REFS, COUNTS, FILTERS)), shards, min_chars)

    def _shard(self) -> F.Column:
        return F.pmod(F.xxhash64("digest"), F.lit(self.shards)).cast("int").alias("shard")

    def _last(self, table: DataFrame, key: str) -> DataFrame:
        return table.groupBy(key).agg(F.max_by(F.struct(*table.columns), "gen").alias("r")).select("r.*")

    def insert(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> LineIndex:
        """With the lines of ``docs``, documents that the index does not hold yet.

        Repeated rows of one id count as one document; null ids and null or
        empty texts add nothing.
        """
        return self.insert_refs(written(references(docs, id_col, text_col, self.min_chars), "line-refs"))

    def insert_refs(self, refs: DataFrame) -> LineIndex:
        gen = self.gen + 1
        batch = (refs.groupBy("digest").agg(F.count_distinct("doc_id").alias("refs"), F.min("doc_id").alias("owner"))
                 .select(self._shard(), "digest", "refs", "owner"))
        asked = written(batch.groupBy("shard").cogroup(self._last(self.filters, "shard").groupBy("shard")).applyInPandas(
            _insert_shard, "shard int, digest binary, refs long, owner long, known boolean, filter binary"), "line-asked")
        rows = asked.filter("digest is not null")
        new = rows.filter("not known").select("digest", "refs", "owner")
        met = rows.filter("known").select("digest", "refs", "owner")
        old = self._last(self.counts, "digest").join(met.select("digest"), "digest", "left_semi").select("digest", "refs", "owner")
        both = met.union(old).groupBy("digest").agg(F.sum("refs").alias("refs"), F.min("owner").alias("owner"))
        counts = written(new.union(both).withColumn("gen", F.lit(gen)), "line-counts")
        held = old.filter("refs > 0").select("digest")
        fresh = written(rows.filter("known").join(held, "digest", "left_anti").select("shard", "digest"), "line-fresh")
        filters = written(fresh.groupBy("shard").cogroup(asked.filter("filter is not null").select("shard", "filter").groupBy("shard")).applyInPandas(
            _add_shard, "shard int, filter binary").select("shard", F.lit(gen).alias("gen"), "filter"), "line-filters")
        return LineIndex(self.refs.union(refs), self.counts.union(counts), self.filters.union(filters), self.shards, self.min_chars, gen)

    def delete(self, ids: DataFrame) -> LineIndex:
        """Without the documents ``ids`` (doc_id); unknown and null ids change nothing."""
        gen = self.gen + 1
        ids = ids.select(F.col("doc_id").cast("long")).dropna().distinct()
        touched = written(self.refs.join(ids, "doc_id", "left_semi").select("digest").distinct(), "line-touched")
        refs = written(self.refs.join(ids, "doc_id", "left_anti").select("digest", "doc_id"), "line-refs")
        left = (refs.groupBy("digest").agg(F.count_distinct("doc_id").alias("refs"), F.min("doc_id").alias("owner")))
        counts = written(touched.join(left, "digest", "left").select(
            "digest", F.coalesce("refs", F.lit(0).cast("long")).alias("refs"), "owner", F.lit(gen).alias("gen")), "line-counts")
        dead = counts.filter("refs = 0").select(self._shard()).distinct()
        live = self._last(self.counts.union(counts), "digest").filter("refs > 0").select(self._shard(), "digest").join(dead, "shard", "left_semi")
        filters = written(dead.groupBy("shard").cogroup(live.groupBy("shard")).applyInPandas(
            _rebuild_shard, "shard int, filter binary").select("shard", F.lit(gen).alias("gen"), "filter"), "line-filters")
        return LineIndex(refs, self.counts.union(counts), self.filters.union(filters), self.shards, self.min_chars, gen)

    def repeated(self) -> DataFrame:
        """(digest, refs, owner) of the keys that at least two documents hold."""
        return self._last(self.counts, "digest").filter("refs >= 2").select("digest", "refs", "owner")

    def drops(self) -> DataFrame:
        """(doc_id, digests): the keys that each document loses, namely those that a smaller id holds too."""
        refs = written(self.refs.select("digest", "doc_id"), "line-refs-all")
        lost = keyed_join(refs, written(self.repeated(), "line-repeated"), ["digest"], "refs").filter("doc_id <> owner")
        return lost.groupBy("doc_id").agg(F.collect_set("digest").alias("digests"))

    def apply(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """``docs`` with the struct ``kept`` (text, n_lines, n_dropped): the text without the lines it loses.

        A null text is one empty line and comes back as an empty text; a row
        with a null id loses nothing.  Repeated rows stay repeated.
        """
        min_chars = self.min_chars

        def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
            for texts, losses in batches:
                rows = []
                for t, digests in zip(texts, losses, strict=True):
                    lines = t.split("\n")
                    lost = set() if digests is None else set(digests)
                    kept = [x for x in lines if line_digest(x, min_chars) not in lost] if lost else lines
                    rows.append(("\n".join(kept), len(lines), len(lines) - len(kept)))
                yield pd.DataFrame(rows, columns=["text", "n_lines", "n_dropped"])

        kept = F.pandas_udf(run, "text string, n_lines long, n_dropped long")
        drops = self.drops().select(F.col("doc_id").alias("__doc"), F.col("digests").alias("__digests"))
        rows = docs.join(drops, F.col(id_col) == F.col("__doc"), "left")
        return rows.withColumn("kept", kept(F.coalesce(F.col(text_col), F.lit("")), F.col("__digests"))).drop("__doc", "__digests")


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, shards: int | None = None) -> LineIndex:
    """The index of all ``docs``, inserted in two batches so that the second meets the filters of the first.

    Without ``shards`` there is one for every REFS_A_SHARD references, and MIN_SHARDS at least.
    """
    refs = written(references(docs, id_col, text_col, min_chars), "line-refs")
    shards = shards or max(MIN_SHARDS, refs.count() // REFS_A_SHARD)
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2))
    index = LineIndex.empty(docs.sparkSession, shards, min_chars)
    return index.insert_refs(refs.filter(half == 0)).insert_refs(refs.filter(half == 1))


def clean(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` (all columns and rows) with the text that stays; a text that loses all its lines is empty."""
    rows = dedup(docs, id_col, text_col, **options).apply(docs, id_col, text_col)
    return rows.select(*[F.col("kept.text").alias(c) if c == text_col else F.col(c) for c in docs.columns])
