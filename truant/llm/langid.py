"""Language identification by bit-sliced Bloom filters of character n-grams.

The filter is one array of language bitmasks.  An n-gram sets its languages'
bits at K positions, and the AND of the masks at those positions gives all
languages that (may) contain it, in one lookup for all of them.  A text's
n-grams are looked up, per language the set bits are counted and the count is
corrected for the false positives that the filter's fill leads to expect; the
largest corrected share decides.

An n-gram belongs to the languages in which its frequency is at least SHARE of
its largest one; n-grams of all languages tell nothing and are left out.  The
fit takes at most ``rows_a_language`` labelled rows of each language, by the
hash of their id.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from truant.llm._common import written

ORDERS = (3, 4)
K = 3
BITS_A_GRAM = 10
SHARE = 0.25
MIN_COUNT = 3
ROWS_A_LANGUAGE = 3_000
UNDETERMINED = "und"
#: Code points handled at once.
CHUNK = 500_000
SPACE = 32

_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def code_points(text: str) -> np.ndarray:
    """Lower-cased letters, everything else as single spaces, one at either end; empty without a letter."""
    c = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)
    c = np.concatenate(([SPACE], np.where(_letters()[c], c, SPACE), [SPACE])).astype(np.uint32)
    c = c[np.concatenate(([True], (c[1:] != SPACE) | (c[:-1] != SPACE)))]
    return c if len(c) > 1 else c[:0]


def gram_hashes(c: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams at each start, and which of them are real: none goes over two spaces."""
    n = len(c) - order + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    h, real = np.full(n, order, np.uint64), np.ones(n, bool)
    for i in range(order):
        h = (h ^ c[i : i + n].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    gap = (c[1:] == SPACE) & (c[:-1] == SPACE)
    for i in range(order - 1):
        real &= ~gap[i : i + n]
    return h, real


def _positions(h: np.ndarray, size: int) -> Iterator[np.ndarray]:
    for i in range(K):  # another odd factor each time, so that the positions are independent
        x = h * np.uint64((0xFF51AFD7ED558CCD + 0x2545F4914F6CDD1E * i) % (1 << 64))
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0xC4CEB9FE1A85EC53)
        yield (x >> np.uint64(20)) & np.uint64(size - 1)


@dataclass(frozen=True)
class LanguageModel:
    """``masks``: the filter, one bit a language; ``common``: the language of most training rows."""

    languages: list[str]
    masks: np.ndarray
    common: int = 0

    @classmethod
    def build(cls, languages: list[str], grams: np.ndarray, masks: np.ndarray, common: int = 0) -> LanguageModel:
        kind = next(k for k in (np.uint8, np.uint16, np.uint32, np.uint64) if np.iinfo(k).bits >= len(languages))
        size = 1 << max(10, int(np.ceil(np.log2(max(1, len(grams)) * BITS_A_GRAM))))
        table = np.zeros(size, kind)
        for p in _positions(grams, size):
            np.bitwise_or.at(table, p, masks.astype(kind))
        return cls(languages, table, common)

    def false_positives(self) -> np.ndarray:
        fill = np.array([((self.masks >> self.masks.dtype.type(i)) & 1).mean() for i in range(len(self.languages))])
        return fill**K

    def lookup(self, h: np.ndarray) -> np.ndarray:
        """The bitmask of languages of each n-gram."""
        out = None
        for p in _positions(h, len(self.masks)):
            out = self.masks[p] if out is None else out & self.masks[p]
        return out

    def counts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Per text the number of n-grams and the hits of each language."""
        total, hits = np.zeros(len(texts), np.int64), np.zeros((len(texts), len(self.languages)), np.int64)

        def add(owner: np.ndarray, c: np.ndarray) -> None:
            for order in ORDERS:
                h, real = gram_hashes(c, order)
                who, mask = owner[: len(h)][real], self.lookup(h[real])
                total[:] += np.bincount(who, minlength=len(texts))
                for i in range(len(self.languages)):
                    hits[:, i] += np.bincount(who[(mask >> mask.dtype.type(i)) & 1 == 1], minlength=len(texts))

        waiting, size = [], 0
        for i, t in enumerate(texts):
            overlap = max(ORDERS) - 1
            c = code_points(t)
            if len(c) > CHUNK:
                for k in range(0, len(c) - overlap, CHUNK):
                    part = c[k : k + CHUNK + overlap]
                    add(np.full(len(part), i), part)
                    if k + CHUNK + overlap < len(c):  # n-grams inside the overlap come again with the next part
                        self._undo(total, hits, i, c[k + CHUNK : k + CHUNK + overlap])
                continue
            waiting.append((i, c))
            size += len(c)
            if size > CHUNK:
                add(np.concatenate([np.full(len(c), i) for i, c in waiting]), np.concatenate([c for _, c in waiting]))
                waiting, size = [], 0
        if size:
            add(np.concatenate([np.full(len(c), i) for i, c in waiting]), np.concatenate([c for _, c in waiting]))
        return total, hits

    def _undo(self, total: np.ndarray, hits: np.ndarray, i: int, c: np.ndarray) -> None:
        for order in ORDERS:
            h, real = gram_hashes(c, order)
            mask = self.lookup(h[real])
            total[i] -= real.sum()
            for k in range(len(self.languages)):
                hits[i, k] -= int(((mask >> mask.dtype.type(k)) & 1).sum())

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Language and score (its part of all corrected shares) of each text."""
        total, hits = self.counts(texts)
        fp = self.false_positives()
        shares = np.clip((hits - total[:, None] * fp) / (1 - np.minimum(fp, 0.999)), 0, None)
        sums = shares.sum(axis=1)
        best = np.where(sums > 0, shares.argmax(axis=1), self.common)
        score = np.where(sums > 0, shares.max(axis=1) / np.where(sums > 0, sums, 1), 0.0)
        seen = np.array([any(map(str.isalpha, t)) for t in texts], bool) if len(texts) else np.zeros(0, bool)
        return [self.languages[b] if s else UNDETERMINED for b, s in zip(best, seen, strict=True)], np.where(seen, score, 0.0)


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        rows_a_language: int = ROWS_A_LANGUAGE) -> LanguageModel:
    """A model of the rows of ``docs`` with an id, a text and a language; at most 64 languages.

    Repeated rows are learned as often as they come.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).dropna()
    sizes = rows.groupBy("lang").count().orderBy("lang").limit(65).collect()
    languages = [r.lang for r in sizes]
    if len(languages) > 64:
        raise ValueError("more than 64 languages")
    if not languages:
        return LanguageModel([UNDETERMINED], np.zeros(1024, np.uint8))
    # hashes below a language's limit hold about twice the rows wanted, so that few rows are ranked of any number
    limits = F.broadcast(spark.createDataFrame([(r.lang, min(1.0, 2 * rows_a_language / r["count"])) for r in sizes], "lang string, below double"))
    ids = rows.select("lang", "doc_id", F.pmod(F.xxhash64(F.lit(8), "doc_id"), F.lit(1 << 40)).alias("h"))
    few = ids.join(limits, "lang").filter(F.col("h") < F.col("below") * (1 << 40))
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id"))
    picked = written(few.withColumn("nth", nth).filter(F.col("nth") <= rows_a_language).select("doc_id").distinct(), "lang-rows")
    number = {x: i for i, x in enumerate(languages)}

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            langs = np.array([number[x] for x in b.column(0).to_pylist()])
            texts = [code_points(t.as_py()) for t in b.column(1)]
            for lang in set(langs.tolist()):
                c = np.concatenate([t for t, x in zip(texts, langs, strict=True) if x == lang])
                for order in ORDERS:
                    h, real = gram_hashes(c, order)
                    h, n = np.unique(h[real], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(h), lang, np.int32)), pa.array(h.view(np.int64)), pa.array(n)], ["lang", "gram", "n"])

    sample = rows.join(F.broadcast(picked), "doc_id", "left_semi").select("lang", "text")  # rows_a_language * 64 ids at most
    counts = written(sample.mapInArrow(grams, "lang int, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")), "lang-grams")
    totals = F.broadcast(counts.groupBy("lang").agg(F.sum("n").alias("total")))
    freq = counts.join(totals, "lang").withColumn("f", F.col("n") / F.col("total"))
    by_gram = freq.groupBy("gram").agg(F.max("f").alias("most"), F.sum("n").alias("n"), F.collect_list(F.struct("lang", "f")).alias("fs"))
    inside = F.filter("fs", lambda x: x.f >= F.lit(SHARE) * F.col("most"))
    bits = F.aggregate(inside, F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), x.lang)))
    chosen = by_gram.filter(F.col("n") >= MIN_COUNT).select("gram", "n", F.size(inside).alias("k"), bits.alias("mask")).filter(
        (F.col("k") < len(languages)) | F.lit(len(languages) == 1)).orderBy("gram").select("gram", "mask")  # the sampled rows bound them
    table = chosen.toPandas()
    common = max(range(len(sizes)), key=lambda i: (sizes[i]["count"], -i))
    return LanguageModel.build(languages, table["gram"].to_numpy(np.int64).view(np.uint64), table["mask"].to_numpy(np.int64).view(np.uint64), common)


def predict(docs: DataFrame, model: LanguageModel, text: Column) -> DataFrame:
    """``docs`` with the struct ``language`` (lang, score).

    ``und`` with score 0 for a text that is null or has no letter; a text whose
    n-grams are all unknown gets the language of most training rows, score 0.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in batches:
            langs, scores = shared.value.predict([t or "" for t in s])
            yield pd.DataFrame({"lang": langs, "score": scores})

    return docs.withColumn("language", F.pandas_udf(run, "lang string, score double")(F.coalesce(text, F.lit(""))))
