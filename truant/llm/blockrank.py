"""Ranked lexical search over per-term geometric blocks of posting lists.

Documents are dealt to segments by similarity (a range of signatures of random
hyperplanes).  In a segment each term's posting list is cut into blocks of
similar documents: some of the list's own documents are pivots, every posting
goes to the pivot with the nearest signature, and crowded blocks are cut on.
A block keeps the coordinatewise maximum of its documents' impacts.  A query's
weights times that summary bound every score in the block from above.

The search has two phases.  In the first each task scores the documents of
its best-bound blocks; the k-th best score of all is a floor that the result
can't lie under.  In the second a block is skipped if its bound lies under
that floor, or under the k-th best of its task; all documents of the other
blocks are scored in whole numbers.  A document with a score holds one of the
query's terms, so that it is in a block whose bound is no less than its score.

Queries go in groups of about TERMS_A_GROUP terms, each with an index over its
own vocabulary: a term's summaries have the coordinates that some query holds
together with it, as no other is ever asked for.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from truant.llm._common import written

#: Postings of a block, documents of a segment, terms (with repeats) of the queries that are searched together.
BLOCK = 128
SEGMENT = 2048
TERMS_A_GROUP = 50_000
#: About so many segments meet in a task at once.
SEGMENTS_A_TASK = 8

_SPLIT = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

VECTORS = "doc_id long, n long, terms array<int>, tfs array<int>"
INDEX = ("doc_ids array<long>, sizes array<int>, terms array<int>, impacts array<int>, "
         "block_terms array<int>, block_sizes array<int>, block_docs array<int>, summaries array<int>")


def terms_of(text: bytes) -> list[bytes]:
    """Runs of letters, digits and all that isn't ASCII; A-Z lower-cased."""
    return text.translate(_SPLIT).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Queries:
    """Some queries: their keys, vocabulary, occurrences of terms, and what terms occur together."""

    def __init__(self, keys: list[tuple[int, str]]):
        self.keys = keys
        lists = [terms_of(text.encode()) for _, text in keys]
        self.vocabulary = {t: i for i, t in enumerate(sorted({t for own in lists for t in own}))}
        self.terms = [np.unique([self.vocabulary[t] for t in own], return_counts=True) if own else (np.zeros(0, np.int64),) * 2 for own in lists]
        self.holders: list[list[int]] = [[] for _ in self.vocabulary]  # the queries of a term
        for q, (own, _) in enumerate(self.terms):
            for t in own.tolist():
                self.holders[t].append(q)
        self.beside = [np.unique(np.concatenate([self.terms[q][0] for q in held])) for held in self.holders]  # coordinates of a term

    def weights(self, w: np.ndarray) -> np.ndarray:
        """(term, query): the term's weight times its occurrences in the query; floats that hold whole numbers."""
        out = np.zeros((len(self.vocabulary), len(self.keys)))
        for q, (own, n) in enumerate(self.terms):
            out[own, q] = w[own] * n
        return out


def vectors(docs: DataFrame, bq, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n, terms, tfs) of every document with a term: all its terms' number, and those of the vocabulary with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = bq.value.vocabulary
        for b in batches:
            rows = []
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                own = terms_of(text.as_py())
                if own:
                    t, n = np.unique([i for w in own if (i := number.get(w)) is not None], return_counts=True)
                    rows.append((doc_id, len(own), t.astype(np.int32), n.astype(np.int32)))
            if rows:
                d, n, t, c = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(d, pa.int64()), pa.array(n, pa.int64()), pa.array(t, pa.list_(pa.int32())), pa.array(c, pa.list_(pa.int32()))],
                                                 ["doc_id", "n", "terms", "tfs"])

    rows = docs.filter(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(run, VECTORS)


class Statistics:
    """N, L and the documents that hold each term."""

    def __init__(self, n_docs: int, length: int, df: np.ndarray):
        self.n_docs, self.length = n_docs, length
        self.weights = np.array([weight(n_docs, int(x)) for x in df], np.int64)

    def impacts(self, n: np.ndarray, tf: np.ndarray) -> np.ndarray:
        m = 100 - 25 + (25 * n * self.n_docs) // max(1, self.length)
        return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def statistics(rows: DataFrame, n_terms: int) -> Statistics:
    """Of the vectors ``rows``; one number a term of the vocabulary comes to the driver."""
    whole = rows.agg(F.count("*").alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("length")).first()
    df = np.zeros(n_terms, np.int64)
    for r in rows.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
        df[r.t] = r["count"]
    return Statistics(whole.docs, whole.length, df)


def _flat(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """(sizes, values) of a column of lists."""
    return np.asarray(lists.value_lengths().fill_null(0)).astype(np.int64), lists.flatten().to_numpy(zero_copy_only=False)


def signatures(rows: DataFrame, bq, bstats) -> DataFrame:
    """``rows`` with ``signature``: the sides of 64 random hyperplanes through the weighted impacts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = np.random.default_rng(11).standard_normal((len(bq.value.vocabulary), 64))
        w = bstats.value.weights
        for b in batches:
            sizes, t = _flat(b.column(2))
            _, tf = _flat(b.column(3))
            x = w[t] * bstats.value.impacts(np.repeat(b.column(1).to_numpy(), sizes), tf.astype(np.int64)) / 1e6
            sig = np.zeros(b.num_rows, np.uint64)
            ends = np.cumsum(sizes)
            for i, (lo, hi) in enumerate(zip(ends - sizes, ends, strict=True)):
                side = x[lo:hi] @ planes[t[lo:hi]] > 0
                sig[i] = np.packbits(side, bitorder="big").view(">u8")[0]
            yield b.append_column("signature", pa.array(sig.view(np.int64)))

    return rows.mapInArrow(run, VECTORS + ", signature long")


def cut_list(docs: np.ndarray, sig: np.ndarray, block: int) -> list[np.ndarray]:
    """The posting list ``docs`` in blocks of at most ``block`` documents with like signatures."""
    if len(docs) <= block:
        return [docs]
    pivots = docs[np.linspace(0, len(docs) - 1, -(-len(docs) // block)).astype(np.int64)]
    nearest = np.bitwise_count(sig[docs][:, None] ^ sig[pivots][None, :]).argmin(axis=1)
    out = []
    for p in np.unique(nearest):
        own = docs[nearest == p]
        out += np.array_split(own, -(-len(own) // block))
    return out


def build_index(rows: DataFrame, bq, bstats, block: int = BLOCK, segment: int = SEGMENT) -> DataFrame:
    """Segments of the documents: their vectors of impacts, and for each term the blocks of its postings with their summaries."""

    def close(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(parts).combine_chunks()
        ids, n, sig = (t.column(c).to_numpy() for c in ("doc_id", "n", "signature"))
        sizes, terms = _flat(t.column("terms").chunk(0))
        _, tf = _flat(t.column("tfs").chunk(0))
        doc = np.repeat(np.arange(len(ids)), sizes)
        impact = bstats.value.impacts(n[doc], tf.astype(np.int64)).astype(np.int32)
        width = len(bq.value.vocabulary)
        dense = np.zeros((len(ids), width), np.int32) if len(ids) * width <= 1 << 25 else None
        if dense is not None:
            dense[doc, terms] = impact
        order = np.argsort(terms, kind="stable")
        at = np.searchsorted(terms[order], np.arange(width + 1))
        block_terms, block_docs, summaries = [], [], []
        for term in np.flatnonzero(np.diff(at)).tolist():
            own = doc[order[at[term] : at[term + 1]]]
            beside = bq.value.beside[term]
            for part in cut_list(own, sig.view(np.uint64), block):
                block_terms.append(term)
                block_docs.append(part)
                summaries.append(dense[np.ix_(part, beside)].max(axis=0) if dense is not None else _maxima(part, doc, terms, impact, beside))
        lists = {"doc_ids": (ids, pa.int64()), "sizes": (sizes, pa.int32()), "terms": (terms, pa.int32()), "impacts": (impact, pa.int32()),
                 "block_terms": (np.array(block_terms), pa.int32()), "block_sizes": (np.array([len(d) for d in block_docs]), pa.int32()),
                 "block_docs": (np.concatenate([*block_docs, np.zeros(0, np.int64)]), pa.int32()),
                 "summaries": (np.concatenate([*summaries, np.zeros(0, np.int32)]), pa.int32())}
        return pa.RecordBatch.from_arrays([pa.array([v.astype(kind.to_pandas_dtype())], pa.list_(kind)) for v, kind in lists.values()], list(lists))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in batches:
            while b.num_rows:
                held.append(b.slice(0, segment - n))
                n += held[-1].num_rows
                b = b.slice(held[-1].num_rows)
                if n == segment:
                    yield close(held)
                    held, n = [], 0
        if held:
            yield close(held)

    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), bstats.value.n_docs // (SEGMENTS_A_TASK * segment))
    dealt = rows.repartitionByRange(parts, "signature", F.xxhash64("doc_id")).sortWithinPartitions("signature", F.xxhash64("doc_id"))
    return dealt.mapInArrow(run, INDEX)


def _maxima(part: np.ndarray, doc: np.ndarray, terms: np.ndarray, impact: np.ndarray, beside: np.ndarray) -> np.ndarray:
    """The summary of the documents ``part`` in the coordinates ``beside``, from vectors ordered by document."""
    lo, hi = np.searchsorted(doc, part), np.searchsorted(doc, part, side="right")
    at = np.concatenate([np.arange(a, b) for a, b in zip(lo, hi, strict=True)])
    where = np.searchsorted(beside, terms[at])
    fits = (where < len(beside)) & (beside[np.minimum(where, len(beside) - 1)] == terms[at])
    out = np.zeros(len(beside), np.int32)
    np.maximum.at(out, where[fits], impact[at[fits]])
    return out


class Segment:
    """One row of the index, with its blocks' bounds for each query that asks for them."""

    def __init__(self, row: dict, queries: Queries, weights: np.ndarray):
        self.ids = row["doc_ids"]
        doc = np.repeat(np.arange(len(self.ids)), row["sizes"])
        order = np.argsort(row["terms"], kind="stable")
        self.doc, self.impact = doc[order], row["impacts"][order].astype(np.float64)
        self.at = np.searchsorted(row["terms"][order], np.arange(len(queries.vocabulary) + 1))
        ends = np.cumsum(row["block_sizes"])
        self.members = [row["block_docs"][a:b] for a, b in zip(ends - row["block_sizes"], ends, strict=True)]
        self.blocks: list[list[tuple[np.ndarray, int]]] = [[] for _ in queries.keys]  # of a query: (bounds, first block)
        self.queries, self.weights = queries, weights
        terms, first = np.unique(row["block_terms"], return_index=True)
        n = np.diff(np.append(first, len(row["block_terms"])))
        k = 0
        for t, b, count in zip(terms.tolist(), first.tolist(), n.tolist(), strict=True):
            beside, held = queries.beside[t], queries.holders[t]
            s = row["summaries"][k : k + count * len(beside)].reshape(count, len(beside)).astype(np.float64)
            k += count * len(beside)
            for q, bounds in zip(held, (s @ weights[np.ix_(beside, held)]).T, strict=True):
                self.blocks[q].append((bounds, b))

    def candidates(self, q: int, floor: float) -> np.ndarray:
        """Documents (as a mask) of the query's blocks whose bound reaches ``floor``."""
        alive = np.zeros(len(self.ids), bool)
        for bounds, b in self.blocks[q]:
            for i in np.flatnonzero(bounds >= floor).tolist():
                alive[self.members[b + i]] = True
        return alive

    def best_bound(self, q: int) -> float:
        return max((bounds.max() for bounds, _ in self.blocks[q]), default=0.0)

    def scores(self, q: int, alive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) of those ``alive``; sums stay whole numbers below 2 ** 53."""
        terms = self.queries.terms[q][0]
        total = np.zeros(len(self.ids))
        for t in terms.tolist():
            lo, hi = self.at[t], self.at[t + 1]
            own = self.doc[lo:hi]
            live = alive[own]
            total[own[live]] += self.weights[t, q] * self.impact[lo:hi][live]
        found = np.flatnonzero(total > 0)
        return found, total[found]


RESULT = "q int, doc_id long, score long"


def _search(bq, bstats, k: int, bfloor=None):
    """Segments to each query's ``k`` best documents of a task; without ``bfloor`` only of each segment's best blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = bq.value
        weights = queries.weights(bstats.value.weights)
        best = [(np.zeros(0, np.int64), np.zeros(0)) for _ in queries.keys]
        for b in batches:
            for i in range(b.num_rows):
                row = {name: b.column(c)[i].values.to_numpy(zero_copy_only=False) for c, name in enumerate(b.schema.names)}
                seg = Segment(row, queries, weights)
                for q in range(len(queries.keys)):
                    if not seg.blocks[q]:
                        continue
                    ids, score = best[q]
                    floor = max(score[-1] if len(score) == k else 1.0, bfloor.value[q] if bfloor is not None else max(1.0, seg.best_bound(q)))
                    alive = seg.candidates(q, floor)
                    if not alive.any():
                        continue
                    found, s = seg.scores(q, alive)
                    ids, score = np.concatenate((ids, seg.ids[found])), np.concatenate((score, s))
                    top = np.lexsort((ids, -score))[:k]
                    best[q] = ids[top], score[top]
        for q, (ids, score) in enumerate(best):
            if len(ids):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), q, np.int32)), pa.array(ids.astype(np.int64)), pa.array(score.astype(np.int64))],
                                                 ["q", "doc_id", "score"])

    return run


def search_index(index: DataFrame, bq, bstats, k: int = 20) -> DataFrame:
    """(q, rank, doc_id, score): each query's ``k`` best documents, equal scores by ascending id."""
    spark = index.sparkSession
    nth = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "doc_id"))
    first = index.mapInArrow(_search(bq, bstats, k), RESULT).withColumn("nth", nth).filter(F.col("nth") == k)
    floor = np.ones(len(bq.value.keys))
    for r in first.collect():  # one number a query
        floor[r.q] = r.score
    found = index.mapInArrow(_search(bq, bstats, k, spark.sparkContext.broadcast(floor)), RESULT)
    return found.withColumn("rank", nth.cast("int")).filter(F.col("rank") <= k)


def query_groups(items: DataFrame, id_col: str = "item_id", text_col: str = "text", terms_a_group: int = TERMS_A_GROUP) -> Iterator[Queries]:
    """The queries in groups of about ``terms_a_group`` terms, one group at a time on the driver."""
    own = items.filter(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("item_id"), F.col(text_col).alias("text")).distinct()
    size = own.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0] // 6 + 1
    groups = -(-size // terms_a_group)
    for g in range(groups):
        rows = own.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(groups)) == g).orderBy("item_id", "text").collect()
        if rows:
            yield Queries([(r.item_id, r.text) for r in rows])


def ranked(docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK,
           segment: int = SEGMENT, terms_a_group: int = TERMS_A_GROUP) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents with a score above 0 for each row (item_id, text) of ``items``.

    Nulls: documents and items with a null id or text take no part (nor in N
    and L); a text without terms has no score.  Repeated document rows are
    ranked each; equal items count once, other texts under the same id are
    queries of their own.  Empty tables give an empty result.  Other columns
    are not read.
    """
    spark = docs.sparkSession
    results = []
    for queries in query_groups(items, terms_a_group=terms_a_group):
        if not queries.vocabulary:
            continue
        bq = spark.sparkContext.broadcast(queries)
        rows = written(vectors(docs, bq, id_col, text_col), "rank-vectors")
        bstats = spark.sparkContext.broadcast(statistics(rows, len(queries.vocabulary)))
        index = written(build_index(signatures(rows.filter(F.size("terms") > 0), bq, bstats), bq, bstats, block, segment), "rank-index")
        names = spark.createDataFrame(pd.DataFrame({"q": np.arange(len(queries.keys), dtype=np.int32), "item_id": [i for i, _ in queries.keys]}), "q int, item_id long")
        results.append(search_index(index, bq, bstats, k).join(F.broadcast(names), "q").select("item_id", "rank", "doc_id", "score"))
    if not results:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return reduce(DataFrame.union, results)
