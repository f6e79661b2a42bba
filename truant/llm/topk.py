"""Exact top-k by inner product: the three-phase uniform threshold over lists of partial scores.

Vectors are cut into ``slices`` of their dimensions; a task holds the partial
scores of its rows in one slice, a local score list.  Per query:

1. Each task gives its best ``k + 1`` entries of a list and the list's least
   score.  The entries' whole scores are computed, and the k-th best of them is
   a safe cutoff: the k-th best of all rows can't lie below.
2. Scores are counted from the least of their list.  A row that reaches the
   cutoff has its share, cutoff / slices, in one list at least, so each task
   gives all entries from there on.
3. Rows met in all lists have their sum; the others' scores are resolved on
   the whole vectors.  What reaches the cutoff is ranked.

Equal vectors are one entry with their ``k + 1`` least ids, as no others can be
among the k best.  Queries go in blocks of about BLOCK rows, so what is
broadcast doesn't grow with the number of queries.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from truant.llm._common import written

BLOCK = 1024
SLICES = 2
SCALE = 1024
#: Rows of a matrix product at a time.
CHUNK = 4096


def integer_vectors(rows: DataFrame, id_col: str, vector_col: str, scale: int = SCALE) -> DataFrame:
    """(vec_id, v): floor(scale * x) of each component; null ids and unusable vectors left out.

    Repeated rows count once; of different vectors under one id the least counts.
    """
    x = F.col(vector_col)
    usable = x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    ints = F.transform(x, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")))
    good = rows.filter(F.col(id_col).isNotNull() & usable).select(F.col(id_col).cast("long").alias("vec_id"), ints.alias("v"))
    return good.groupBy("vec_id").agg(F.min("v").alias("v"))


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    """Rows of integers as floats (their products stay exact below 2 ** 53), short ones filled with 0."""
    out = np.zeros((len(lists), width))
    sizes = np.asarray(lists.value_lengths().fill_null(0))
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(lists)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _partials(batches: Iterator[pa.RecordBatch], q: np.ndarray, cuts: list[int]):
    """(slice, groups, partial scores) for parts of the rows (group, slice, part)."""
    for b in batches:
        which = b.column(1).to_numpy(zero_copy_only=False)
        for s in range(len(cuts) - 1):
            own = b.filter(pa.array(which == s))
            for k in range(0, own.num_rows, CHUNK):
                part = own.slice(k, CHUNK)
                x = _matrix(part.column(2), cuts[s + 1] - cuts[s])
                yield s, part.column(0).to_numpy(), q[:, cuts[s] : cuts[s + 1]] @ x.T


def _entries(q: np.ndarray, s: np.ndarray | int, g: np.ndarray, p: np.ndarray) -> pa.RecordBatch:
    s = np.broadcast_to(s, q.shape)
    return pa.RecordBatch.from_arrays([pa.array(q.astype(np.int32)), pa.array(s.astype(np.int32)), pa.array(g), pa.array(p.astype(np.int64))],
                                      ["q", "slice", "grp", "score"])


ENTRY = "q int, slice int, grp long, score long"


def _local_lists(bq, cuts: list[int], k: int):
    """Phase 1: the best entries of each list; the list's least score comes with a null group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = bq.value
        best: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        least: dict[int, np.ndarray] = {}
        for s, groups, p in _partials(batches, q, cuts):
            g = np.broadcast_to(groups, p.shape)
            least[s] = np.minimum(least[s], p.min(axis=1)) if s in least else p.min(axis=1)
            if s in best:
                p, g = np.concatenate([best[s][0], p], axis=1), np.concatenate([best[s][1], g], axis=1)
            if p.shape[1] > k:
                top = np.argpartition(-p, k - 1, axis=1)[:, :k]
                p, g = np.take_along_axis(p, top, 1), np.take_along_axis(g, top, 1)
            best[s] = p, g
        for s, (p, g) in best.items():
            yield _entries(np.repeat(np.arange(len(q)), p.shape[1]), s, g.ravel(), p.ravel())
            rows = _entries(np.arange(len(q)), s, np.zeros(len(q), np.int64), least[s])
            yield rows.set_column(2, "grp", pa.nulls(len(q), pa.int64()))

    return run


def _above(bq, cuts: list[int], bcut):
    """Phase 2: all entries that have their share of the cutoff."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least, shifted = bcut.value  # of each query and slice; the cutoff counted from the least scores
        m = len(cuts) - 1
        for s, groups, p in _partials(batches, bq.value, cuts):
            q, at = np.nonzero(m * (p - least[:, s : s + 1]) >= shifted[:, None])
            yield _entries(q, s, groups[at], p[q, at])

    return run


def _resolve(bq, bcut=None):
    """(grp, v, queries) to whole scores (q, grp, score), from the cutoff on if there is one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = bq.value
        for b in batches:
            x, lists = _matrix(b.column(1), q.shape[1]), b.column(2)
            row = np.repeat(np.arange(b.num_rows), np.asarray(lists.value_lengths().fill_null(0)))
            who = lists.flatten().to_numpy(zero_copy_only=False)
            for k in range(0, len(who), CHUNK):
                r, w = row[k : k + CHUNK], who[k : k + CHUNK]
                score = np.einsum("ij,ij->i", q[w], x[r])
                keep = score >= bcut.value[w] if bcut is not None else np.ones(len(w), bool)
                out = _entries(w[keep], 0, b.column(0).to_numpy()[r[keep]], score[keep])
                yield out.drop_columns(["slice"])

    return run


WHOLE = "q int, grp long, score long"


def search(rows: DataFrame, is_query: str, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
           scale: int = SCALE, slices: int = SLICES, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k best rows but itself, ties to the smaller vec_id.

    ``is_query`` is an SQL condition on ``vec_id``.  Fewer rows than k give all.
    Vectors that are null or hold null or non-finite components, and null ids,
    take no part; shorter vectors count as filled up with 0; an empty table
    gives an empty result.  Other columns are not read.
    """
    spark = rows.sparkSession
    vectors = written(integer_vectors(rows, id_col, vector_col, scale), "topk-vectors")
    nth = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    least = vectors.withColumn("nth", nth).filter(F.col("nth") <= k + 1)
    groups = written(least.groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")).select(
        F.col("ids")[0].alias("grp"), "ids", "v"), "topk-groups")
    queries = vectors.filter(is_query)
    n, width = queries.count(), groups.agg(F.max(F.size("v"))).first()[0] or 0
    blocks = -(-n // block)
    slices = max(1, min(slices, width))
    cuts = [width * i // slices for i in range(slices + 1)]
    parts = F.array(*[F.struct(F.lit(s).alias("slice"), F.slice("v", cuts[s] + 1, max(1, cuts[s + 1] - cuts[s])).alias("part")) for s in range(slices)])
    lists = written(groups.select("grp", F.inline(parts)), "topk-slices")
    results = []
    for b in range(blocks):
        mine = queries.filter(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b).orderBy("vec_id").collect()  # about ``block`` rows
        if mine:
            results.append(_search_block(spark, mine, groups, lists, cuts, k))
    if not results:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    return reduce(DataFrame.union, results)


def _search_block(spark, mine: list, groups: DataFrame, lists: DataFrame, cuts: list[int], k: int) -> DataFrame:
    q = np.zeros((len(mine), cuts[-1]))
    for i, r in enumerate(mine):
        q[i, : len(r.v)] = r.v
    ids = np.array([r.vec_id for r in mine])
    bq = spark.sparkContext.broadcast(q)
    named = F.broadcast(spark.createDataFrame([(i, int(v)) for i, v in enumerate(ids)], "q int, query_id long"))

    # phase 1: local lists, and the k-th best whole score of what they hold
    local = written(lists.mapInArrow(_local_lists(bq, cuts, k + 1), ENTRY), "topk-local")
    best = F.row_number().over(Window.partitionBy("q", "slice").orderBy(F.desc("score"), "grp"))
    gathered = local.filter("grp is not null").withColumn("nth", best).filter(F.col("nth") <= k + 1)
    asked = gathered.groupBy("grp").agg(F.collect_set("q").alias("queries"))
    whole = groups.join(asked, "grp").select("grp", "v", "queries").mapInArrow(_resolve(bq), WHOLE)
    other = whole.join(groups.select("grp", "ids"), "grp").join(named, "q").filter("size(ids) > 1 or ids[0] <> query_id")
    kth = other.withColumn("nth", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score")))).filter(F.col("nth") == k)
    least = np.zeros((len(q), len(cuts) - 1))
    for r in local.filter("grp is null").groupBy("q", "slice").agg(F.min("score").alias("score")).collect():
        least[r.q, r.slice] = r.score
    cutoff = np.full(len(q), -np.inf)
    for r in kth.select("q", "score").collect():
        cutoff[r.q] = r.score
    bcut = spark.sparkContext.broadcast((least, cutoff - least.sum(axis=1)))
    bwhole = spark.sparkContext.broadcast(cutoff)

    # phase 2: every entry with its share of the cutoff
    found = lists.mapInArrow(_above(bq, cuts, bcut), ENTRY).groupBy("grp", "q").agg(F.sum("score").alias("score"), F.count("*").alias("seen"))
    found = written(found, "topk-found")

    # phase 3: whole sums are known, the rest is resolved on the vectors
    limit = F.broadcast(spark.createDataFrame([(i, float(c)) for i, c in enumerate(cutoff)], "q int, cutoff double"))
    summed = found.filter(F.col("seen") == len(cuts) - 1).join(limit, "q").filter("score >= cutoff").select("q", "grp", "score")
    open_ = found.filter(F.col("seen") < len(cuts) - 1).groupBy("grp").agg(F.collect_list("q").alias("queries"))  # a block of queries at most
    resolved = groups.join(open_, "grp").select("grp", "v", "queries").mapInArrow(_resolve(bq, bwhole), WHOLE)
    rows = summed.union(resolved).join(groups.select("grp", "ids"), "grp").join(named, "q")
    rows = rows.select("query_id", "score", F.explode("ids").alias("vec_id")).filter("vec_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return written(rows.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"), "topk-result")
