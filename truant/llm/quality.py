"""Quality classifier by compression: a zstandard dictionary of good and one of bad labelled text.

A text compresses better with the dictionary of its own kind.  It is cut into
pieces of ``PIECE`` bytes, so that the dictionary and not the text's own past
decides, and all pieces are compressed with both dictionaries.  The difference
of the two sizes, normalised by the text's size, goes through a logistic curve
fitted on further labelled rows.  A constant SHRINK in the divisor takes weight
from short texts, and the curve starts from the share of good rows: a text too
short to tell anything has that score.

The fit takes a bounded sample of the labelled rows, by the hash of their id:
``dict_rows`` of each label for the dictionaries (``PIECES_A_ROW`` pieces of
each, none from lines that several sampled rows share) and ``fit_rows`` for the
curve, either from its own half of the rows.  Only text goes into a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from truant.llm._common import written

PIECE = 512
DICT_BYTES = 65_536
LEVEL = 3
SHRINK = 128
DICT_ROWS = 1_500
FIT_ROWS = 6_000
PIECES_A_ROW = 4


def build_dictionary(samples: list[bytes], size: int = DICT_BYTES) -> bytes:
    """A trained dictionary; of too few samples for training their last ``size`` bytes."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    if not dictionary:
        return zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)
    d = zstandard.ZstdCompressionDict(dictionary)
    d.precompute_compress(LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_dict_id=False, write_checksum=False)


def size_difference(text: str | None, good: zstandard.ZstdCompressor, bad: zstandard.ZstdCompressor) -> float:
    """(bad - good) / (size + SHRINK), of the compressed sizes and the size of the whole text; 0 for an empty one."""
    raw = (text or "").encode()
    pieces = [raw[i : i + PIECE] for i in range(0, len(raw), PIECE)]
    g, b = (sum(len(c.compress(p)) for p in pieces) for c in (good, bad))
    return (b - g) / (len(raw) + SHRINK)


@dataclass(frozen=True)
class QualityModel:
    """Two dictionaries and the curve 1 / (1 + exp(-logit))."""

    good: bytes
    bad: bytes
    prior: float = 0.0
    slope: float = 0.0
    offset: float = 0.0

    def logit(self, difference, size):
        """Of numbers or columns: the log odds of a text of ``size`` bytes."""
        return self.prior + self.slope * difference + self.offset * (size / (size + SHRINK))

    def difference(self, text: Column) -> Column:
        good, bad = self.good, self.bad

        def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            g, b = _compressor(good), _compressor(bad)
            for s in batches:
                yield pd.Series([size_difference(t, g, b) for t in s], dtype="float64")

        return F.pandas_udf(run, "double")(F.coalesce(text, F.lit("")))

    def score(self, text: Column) -> Column:
        """Probability of a good text; a null or empty one has the share of good training rows."""
        return 1 / (1 + F.exp(-self.logit(self.difference(text), F.octet_length(F.coalesce(text, F.lit(""))))))


def fit_curve(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> tuple[float, float, float]:
    """Prior, slope and offset of a logistic regression, by Newton steps.

    Columns of ``x``: difference and weight.  The prior is the smoothed log
    odds of the labels; without both labels the others are 0.
    """
    n, ones = len(y), float(y.sum())
    prior = float(np.log((ones + 1) / (n - ones + 1)))
    w = np.zeros(2)
    if 0 < ones < n:
        a = x * [10, 1]  # of like size
        for _ in range(100):
            p = 1 / (1 + np.exp(-np.clip(prior + a @ w, -30, 30)))
            step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + ridge * np.eye(2), a.T @ (y - p) - ridge * w)
            w += np.clip(step, -5, 5)
            if np.abs(step).max() < 1e-8:
                break
    return prior, float(w[0] * 10), float(w[1])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        dict_rows: int = DICT_ROWS, fit_rows: int = FIT_ROWS) -> QualityModel:
    """A model of the rows of ``labels`` (id, label 0 or 1) that ``docs`` has.

    Labels other than 0 and 1 and null ids are left out; an id with both labels
    counts as 0, of repeated rows one is learned.  Without rows of a label its
    dictionary is empty, and without both labels every score is the smoothed
    share of label 1.
    """
    known = (labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).alias("y")).filter("doc_id is not null and y in (0, 1)")
             .groupBy("doc_id").agg(F.min("y").alias("y"))
             .join(docs.select(F.col(id_col).alias("doc_id")), "doc_id", "left_semi")
             .withColumn("h", F.xxhash64(F.lit(4), "doc_id")))
    known = written(known, "quality-labels")
    sizes = {r.y: r["count"] for r in known.groupBy("y").count().collect()}
    pool, place = F.pmod(F.col("h"), F.lit(2)), F.pmod(F.shiftright("h", 1), F.lit(1 << 40))

    def first(rows: DataFrame, size: int, wanted: int, use: str) -> DataFrame:
        """The ``wanted`` least hashes of about ``size`` rows; only hashes that low on average, doubled, are sorted."""
        below = int(min(1.0, 2 * wanted / max(1, size)) * (1 << 40))
        return rows.filter(place < below).orderBy(place, "doc_id").limit(wanted).withColumn("use", F.lit(use))

    taken = [first(known.filter((pool == 0) & (F.col("y") == y)), sizes.get(y, 0) // 2, dict_rows, "dict") for y in (0, 1)]
    rest = first(known.filter(pool == 1), sum(sizes.values()) // 2, fit_rows, "fit")
    # 2 * dict_rows + fit_rows at most, so small enough to broadcast
    sample = written(taken[0].union(taken[1]).union(rest).select("doc_id", "y", "use"), "quality-rows")
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(F.broadcast(sample), "doc_id")
    texts = written(texts, "quality-sample")

    lines = texts.filter("use = 'dict'").select("doc_id", "y", F.explode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("line")).filter("line <> ''")
    lines = lines.groupBy("line").agg(F.count_distinct("doc_id").alias("docs"), F.min("doc_id").alias("doc_id"), F.min("y").alias("y")).filter("docs = 1")
    at = F.explode(F.sequence(F.lit(1), F.length("line"), F.lit(PIECE)))
    pieces = lines.select("doc_id", "y", "line", at.alias("at")).select("doc_id", "y", F.substring("line", F.col("at"), PIECE).alias("piece"))
    nth = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.xxhash64("piece"), "piece"))
    pieces = pieces.withColumn("nth", nth).filter(F.col("nth") <= PIECES_A_ROW).orderBy("doc_id", "nth").select("y", "piece").collect()
    dicts = {y: build_dictionary([r.piece.encode() for r in pieces if r.y == y]) for y in (0, 1)}

    model = QualityModel(good=dicts[1], bad=dicts[0])
    size = F.octet_length(F.coalesce("text", F.lit("")))
    rows = texts.filter("use = 'fit'").select("y", model.difference(F.col("text")).alias("x"), size.alias("n")).collect()
    found = np.array(sorted((r.x, r.n / (r.n + SHRINK), r.y) for r in rows), float).reshape(-1, 3)
    return QualityModel(dicts[1], dicts[0], *fit_curve(found[:, :2], found[:, 2]))
