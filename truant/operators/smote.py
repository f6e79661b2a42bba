"""SMOTE: synthetic minority rows ``x + u * (nn - x)`` until classes are equal.

Exact k-nearest neighbours without a cross join:

1. Identical feature vectors are merged first (``groupBy(vector)`` with a
   multiplicity), so a heavily repeated vector is one row, never a hot group.
2. A tree splits the space on several directions: from a bounded sample, each
   node is cut at the median of its widest dimension, down to leaves of about
   ``rows_per_leaf`` vectors (at most MAX_LEAVES leaves).  All vectors are
   assigned to leaves, and every node's bounding box is known.
3. Neighbours are searched inside each leaf.  That gives, per vector, an upper
   bound ``D_k`` on its k-th neighbour distance.
4. A vector visits only the other leaves whose box lies within ``D_k``, found
   by going down the tree.  Visits are grouped by (leaf, part), so that a group
   has at most about VISITS_PER_GROUP visitors, whatever their number.
5. Candidates are merged per vector: the k nearest rows counting
   multiplicities (a vector's own duplicates first, at distance 0).

In many independent dimensions no box is far from any vector, and the exact
search visits most leaves: its work is quadratic there (README has figures).
:func:`truant.operators.knn_graph.knn_graph` is the approximate form for that
case (``method="graph"``); :func:`knn_lsh` is another, for one fixed radius.

Synthetic rows are drawn by hash: draw j takes minority row ``hash(seed, j)
mod m``, neighbour slot ``hash(seed + 1, j) mod k`` and gap
``hash_unit(seed + 2, j)``, so the result does not depend on partitioning.
A vector holding a large share of the minority rows gets a matching share
of the draws; those draws are spread over salted copies of its k slot rows
(one broadcast of at most ``HOT_SHARE`` hot vectors), never one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import BucketedRandomProjectionLSH
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from truant.functions.hashing import hash60, hash_unit
from truant.operators.knn_graph import knn_graph
from truant.operators.sampling import class_rank, draw_partitions, stratum_counts
from truant.schema import KEY, TARGET
from truant.session import materialize, ship_package

CAND_SCHEMA = "q string, nb string, dist double, w long"
HOT_SHARE = 1000      # a vector above 1/HOT_SHARE of the minority rows is salted
SALT_ROWS = 1_000_000  # expected draws per salt of a hot vector
ROWS_PER_LEAF = 512
MAX_LEAVES = 65_536
SAMPLE_PER_LEAF = 16   # vectors the tree is built from, per leaf
VISITS_PER_GROUP = 20_000
BLOCK_CELLS = 4_000_000  # distances held at once (32 MB)


# ------------------------------------------------------------------ kernel
def _weighted_topk(qv, qid, qself, pv, pid, pw, k):
    """For each query row: nearest points until the multiplicity sum reaches
    k.  ``qself`` is the query's own extra copies (counted at distance 0).

    Squared distances of a block come from one matrix product (queries x
    points numbers); all points up to the k-th of them, and a rounding margin,
    are then measured exactly and sorted by (distance, point id).
    """
    out = [[], [], [], []]
    if len(pv) == 0 or len(qv) == 0:
        return out
    qid, pid = np.asarray(qid).astype(str), np.asarray(pid).astype(str)
    qself, pw = np.asarray(qself, dtype=np.int64), np.asarray(pw, dtype=np.int64)
    prank = np.argsort(np.argsort(pid, kind="stable"), kind="stable")  # tie-break by point id
    pn = (pv * pv).sum(axis=1)
    step = max(1, BLOCK_CELLS // len(pv))
    for lo in range(0, len(qv), step):
        q, ids, own = qv[lo:lo + step], qid[lo:lo + step], qself[lo:lo + step]
        qn = (q * q).sum(axis=1)
        near = qn[:, None] + pn[None, :] - 2 * (q @ pv.T)
        near[ids[:, None] == pid[None, :]] = np.inf            # the vector itself is not its neighbour
        kth = np.partition(near, min(k, len(pv)) - 1, axis=1)[:, min(k, len(pv)) - 1]
        margin = 1e-9 * (qn + pn.max() + 1)
        rows, cols = np.nonzero(np.isfinite(near) & (near <= (kth + margin)[:, None]))
        d = np.sqrt(((q[rows] - pv[cols]) ** 2).sum(axis=1))
        order = np.lexsort((prank[cols], d, rows))
        rows, cols, d = rows[order], cols[order], d[order]
        w = pw[cols]
        total = np.cumsum(w) - w
        before = total - (total[np.searchsorted(rows, rows)] if len(rows) else 0)
        need = np.maximum(k - own, 0)[rows]
        keep = before < need
        used = np.minimum(w, need - before)
        twins = np.nonzero(own > 0)[0]
        for col, a, b in zip(out, (ids[twins], ids[twins], np.zeros(len(twins)), np.minimum(own[twins], k)),
                             (ids[rows[keep]], pid[cols[keep]], d[keep], used[keep]), strict=True):
            col.extend(a.tolist())
            col.extend(b.tolist())
    return out


def _frame(q, nb, d, w) -> pd.DataFrame:
    return pd.DataFrame({"q": pd.Series(q, dtype=object), "nb": pd.Series(nb, dtype=object),
                         "dist": pd.Series(d, dtype="float64"), "w": pd.Series(w, dtype="int64")})


def _stack(s) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=float) for v in s]) if len(s) else np.zeros((0, 0))


# -------------------------------------------------------------------- tree
@dataclass
class LeafTree:
    """A binary tree in arrays: node i has children 2i+1 and 2i+2; ``dim`` is -1 at a leaf."""

    dim: np.ndarray
    cut: np.ndarray
    low: np.ndarray    # bounding boxes, filled in from all vectors
    high: np.ndarray

    @classmethod
    def build(cls, sample: np.ndarray, leaves: int) -> LeafTree:
        depth = max(0, int(np.ceil(np.log2(max(1, leaves)))))
        size, d = (1 << (depth + 1)) - 1, sample.shape[1]
        dim, cut = np.full(size, -1), np.zeros(size)
        rows = {0: sample}
        for i in range((1 << depth) - 1):
            own = rows.pop(i, None)
            if own is None or len(own) < 2:
                continue
            spread = own.max(axis=0) - own.min(axis=0)
            j = int(np.argmax(own.std(axis=0) * (spread > 0)))
            c = float(np.median(own[:, j]))
            right = own[:, j] > c
            if not right.any() or right.all():  # many equal values: cut at the mean
                c = float(own[:, j].mean())
                right = own[:, j] > c
            if not right.any() or right.all():
                continue
            dim[i], cut[i] = j, c
            rows[2 * i + 1], rows[2 * i + 2] = own[~right], own[right]
        return cls(dim, cut, np.full((size, d), np.inf), np.full((size, d), -np.inf))

    def leaf(self, v: np.ndarray) -> np.ndarray:
        at = np.zeros(len(v), np.int64)
        while True:
            j = self.dim[at]
            inner = np.flatnonzero(j >= 0)
            if not len(inner):
                return at
            node = at[inner]
            at[inner] = 2 * node + 1 + (v[inner, j[inner]] > self.cut[node])

    def set_boxes(self, leaves: list[tuple[int, list, list]]) -> None:
        for i, lo, hi in leaves:
            self.low[i], self.high[i] = lo, hi
        for i in range(len(self.dim) - 1, 0, -1):
            up = (i - 1) // 2
            self.low[up], self.high[up] = np.minimum(self.low[up], self.low[i]), np.maximum(self.high[up], self.high[i])

    def visits(self, v: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) of all leaves whose box lies within a row's radius."""
        row, node = np.arange(len(v)), np.zeros(len(v), np.int64)
        out = []
        while len(row):
            gap = np.maximum(0, np.maximum(self.low[node] - v[row], v[row] - self.high[node]))
            near = (gap * gap).sum(axis=1) <= radius[row] ** 2 * (1 + 1e-12)
            near &= np.isfinite(self.low[node, 0])  # nodes without vectors are never visited
            row, node = row[near], node[near]
            ends = self.dim[node] < 0
            out.append((row[ends], node[ends]))
            row, node = row[~ends], node[~ends]
            row, node = np.concatenate([row, row]), np.concatenate([2 * node + 1, 2 * node + 2])
        return np.concatenate([r for r, _ in out]), np.concatenate([n for _, n in out])


def _with_leaves(vectors: DataFrame, tree) -> DataFrame:
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series(tree.value.leaf(_stack(s)) if len(s) else [], dtype="int64")

    return vectors.withColumn("leaf", F.pandas_udf(run, "long")("v"))


def build_tree(vectors: DataFrame, n: int, rows_per_leaf: int = ROWS_PER_LEAF) -> tuple[DataFrame, LeafTree]:
    """(vectors with their leaf, written; the tree with all boxes).

    The sample the tree is built from has SAMPLE_PER_LEAF vectors a leaf, so
    at most SAMPLE_PER_LEAF * MAX_LEAVES.
    """
    spark = vectors.sparkSession
    leaves = max(1, min(MAX_LEAVES, n // rows_per_leaf))
    sample = vectors.orderBy(F.xxhash64("vid")).limit(SAMPLE_PER_LEAF * leaves) if n > SAMPLE_PER_LEAF * leaves else vectors
    tree = LeafTree.build(_stack([r[0] for r in sample.select("v").collect()]), leaves)
    # the k-NN stages are heavy in compute and light in bytes: an explicit
    # partition count (not coalesced by AQE) keeps them parallel
    parts = max(1, min(leaves, 4 * spark.sparkContext.defaultParallelism))
    placed = materialize(_with_leaves(vectors, spark.sparkContext.broadcast(tree)).repartition(parts, "leaf"), "leaves")
    d = tree.low.shape[1]
    boxes = placed.groupBy("leaf").agg(F.array(*[F.min(F.col("v")[j]) for j in range(d)]).alias("lo"),
                                       F.array(*[F.max(F.col("v")[j]) for j in range(d)]).alias("hi"))
    tree.set_boxes([tuple(r) for r in boxes.collect()])  # MAX_LEAVES at most
    return placed, tree


def leaf_visits(placed: DataFrame, tree: LeafTree, bound: DataFrame) -> DataFrame:
    """(vid, v, leaf) of the visits to other leaves; ``bound``: (q, dk) per vector."""
    shared = placed.sparkSession.sparkContext.broadcast(tree)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = _stack(b.column(1).to_pylist())
            own, dk = b.column(2).to_numpy(), b.column(3).to_numpy()
            for lo in range(0, len(v), 256):
                row, leaf = shared.value.visits(v[lo:lo + 256], dk[lo:lo + 256])
                row = row + lo
                other = leaf != own[row]
                picked = b.take(pa.array(row[other]))
                yield pa.RecordBatch.from_arrays([picked.column(0), picked.column(1), pa.array(leaf[other])], ["vid", "v", "leaf"])

    rows = placed.join(bound, placed.vid == bound.q, "left").select("vid", "v", "leaf", F.coalesce("dk", F.lit(float("inf"))).alias("dk"))
    return rows.mapInArrow(run, "vid string, v array<double>, leaf long")


def knn_distinct(vectors: DataFrame, k: int = 5, rows_per_leaf: int = ROWS_PER_LEAF) -> DataFrame:
    """``vectors``: (vid string, v array<double>, c long multiplicity).
    Returns (q, nb, dist, w): the k nearest rows of each distinct vector,
    multiplicities counted, the vector itself excluded once."""
    spark = vectors.sparkSession
    ship_package(spark)
    n = vectors.count()
    if not n:
        return spark.createDataFrame([], CAND_SCHEMA)
    placed, tree = build_tree(vectors, n, rows_per_leaf)
    parts = max(1, min(max(1, n // rows_per_leaf), 4 * spark.sparkContext.defaultParallelism))

    def local(pdf: pd.DataFrame) -> pd.DataFrame:
        v, c = _stack(pdf["v"]), pdf["c"].to_numpy()
        return _frame(*_weighted_topk(v, pdf["vid"].to_numpy(), c - 1, v, pdf["vid"].to_numpy(), c, k))

    c1 = materialize(placed.repartition(parts, "leaf").groupBy("leaf").applyInPandas(local, CAND_SCHEMA), "knn-local")
    # k-th neighbour distance bound per vector (inf when the leaf is short)
    bound = c1.groupBy("q").agg(F.sum("w").alias("got"), F.max("dist").alias("dk"))
    bound = bound.select("q", F.when(F.col("got") >= k, F.col("dk")).otherwise(F.lit(float("inf"))).alias("dk"))
    visits = materialize(leaf_visits(placed, tree, bound), "knn-visits")
    groups = visits.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / VISITS_PER_GROUP).alias("parts"))
    groups = materialize(groups, "knn-groups")  # one row a leaf, MAX_LEAVES at most
    asked = visits.join(F.broadcast(groups), "leaf").select("vid", "v", "leaf", F.pmod(F.xxhash64("vid"), "parts").alias("part"))
    points = placed.join(F.broadcast(groups), "leaf").select(
        F.col("vid").alias("pid"), F.col("v").alias("pv"), F.col("c").alias("pc"), "leaf", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))

    def remote(qdf: pd.DataFrame, pdf: pd.DataFrame) -> pd.DataFrame:
        if len(qdf) == 0 or len(pdf) == 0:
            return _frame([], [], [], [])
        return _frame(*_weighted_topk(_stack(qdf["v"]), qdf["vid"].to_numpy(), np.zeros(len(qdf), dtype=int), _stack(pdf["pv"]),
                                      pdf["pid"].to_numpy(), pdf["pc"].to_numpy(), k))

    c2 = (asked.repartition(parts, "leaf", "part").groupBy("leaf", "part")
          .cogroup(points.repartition(parts, "leaf", "part").groupBy("leaf", "part")).applyInPandas(remote, CAND_SCHEMA))
    return _trim(c1.unionByName(c2), k)


def _trim(cand: DataFrame, k: int) -> DataFrame:
    """The k nearest rows per vector of the candidates, multiplicities counted."""
    w = Window.partitionBy("q").orderBy("dist", "nb").rowsBetween(Window.unboundedPreceding, 0)
    ranked = cand.withColumn("cw", F.sum("w").over(w))
    kept = ranked.where(F.col("cw") - F.col("w") < k)
    # trim the last one so the multiset has exactly k rows
    return kept.withColumn("w", F.least(F.col("w"), F.lit(k) - (F.col("cw") - F.col("w")))).drop("cw")


def knn_lsh(vectors: DataFrame, k: int = 5, radius: float = 1.0, bucket_length: float = 1.0, tables: int = 8, seed: int = 42) -> DataFrame:
    """Approximate form of :func:`knn_distinct` by random projections (MLlib):
    of the vectors that share a bucket and lie within ``radius``, the k
    nearest; a vector's own duplicates count first.  Its recall depends on the
    data and must be measured (a test does)."""
    v = vectors.withColumn("features", array_to_vector("v")).select("vid", "c", "features")
    lsh = BucketedRandomProjectionLSH(inputCol="features", outputCol="buckets", bucketLength=bucket_length, numHashTables=tables, seed=seed)
    pairs = lsh.fit(v).approxSimilarityJoin(v, v, radius, "dist").where("datasetA.vid <> datasetB.vid")
    cand = pairs.select(F.col("datasetA.vid").alias("q"), F.col("datasetB.vid").alias("nb"), "dist", F.col("datasetB.c").alias("w"))
    own = vectors.where("c > 1").select(F.col("vid").alias("q"), F.col("vid").alias("nb"), F.lit(0.0).alias("dist"), (F.col("c") - 1).alias("w"))
    return _trim(cand.unionByName(own), k)


# ------------------------------------------------------------------- smote
def _slots(knn: DataFrame) -> DataFrame:
    """(q, slot 0..k-1, nb): the k-nearest multiset laid out as slots."""
    w = Window.partitionBy("q").orderBy("dist", "nb").rowsBetween(Window.unboundedPreceding, 0)
    s = knn.withColumn("end", F.sum("w").over(w)).withColumn("start", F.col("end") - F.col("w"))
    return (s.withColumn("slot", F.explode(F.sequence(F.col("start"), F.col("end") - 1)))
             .select("q", "slot", "nb"))


def _all_slots(slots: DataFrame, distinct: DataFrame, k: int) -> DataFrame:
    """``slots`` with k of them for each vector: one that knows fewer neighbours
    uses them in turn, and one that knows none is its own."""
    own = slots.groupBy("q").agg(F.transform(F.array_sort(F.collect_list(F.struct("slot", "nb"))), lambda s: s["nb"]).alias("nbs"))
    rows = distinct.select(F.col("vid").alias("q")).join(own, "q", "left").withColumn("nbs", F.coalesce("nbs", F.array("q")))
    return rows.select("q", F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.get("nbs", i % F.size("nbs")))).alias("slot", "nb"))


def smote(df: DataFrame, features: list[str], target: str = TARGET, key: str = KEY, minority=1,
          k: int = 5, seed: int = 42, n: int | None = None, rows_per_leaf: int = ROWS_PER_LEAF, method: str = "exact",
          **graph) -> DataFrame:
    """Original rows plus ``n`` synthetic minority rows (default: the class
    gap).  Synthetic rows have a null key and ``synthetic = 1``; integer
    features become fractional, so all features are returned as double.

    ``method``: "exact" neighbours, or "graph" for those of a refined neighbour
    graph (``graph``: degree, rounds, least_change of
    :func:`truant.operators.knn_graph.knn_graph`), whose work per vector doesn't
    grow with their number in many dimensions."""
    if method not in ("exact", "graph"):
        raise ValueError(f"method is exact or graph, not {method}")
    counts = stratum_counts(df, target)
    mino = str(minority)
    m = counts.get(mino, 0)
    n = (max(counts.values()) - m) if n is None else n
    spark = df.sparkSession
    vec = F.array(*[F.col(c).cast("double") for c in features])
    kk = min(k, max(m - 1, 0))
    base = df.select(key, *[F.col(c).cast("double").alias(c) for c in features],
                     F.col(target), F.lit(0).alias("synthetic"))
    if n <= 0 or kk == 0:
        return base
    mrows = df.where(F.col(target).cast("string") == mino).select(key, vec.alias("v"))
    mrows = materialize(mrows.withColumn("vid", F.md5(F.to_json("v"))), "minority")
    distinct = materialize(mrows.groupBy("vid").agg(F.first("v").alias("v"), F.count(F.lit(1)).alias("c")), "minority-distinct")
    slots = _all_slots(_slots(knn_graph(distinct, kk, seed=seed, **graph)), distinct, kk) if method == "graph" else _slots(knn_distinct(distinct, kk, rows_per_leaf))
    slots = slots.select(F.col("q").alias("__q"), F.col("slot").alias("__slot"), "nb")
    ranked = class_rank(mrows.withColumn("__t", F.lit(mino)), "__t", key, seed, "__r") \
        .select(F.col("__r").alias("__idx"), "vid", "v")
    draws = spark.range(0, n, 1, draw_partitions(n)).select(
        (F.pmod(hash60(seed, F.col("id")), F.lit(m)) + 1).alias("__idx"),
        F.pmod(hash60(seed + 1, F.col("id")), F.lit(kk)).alias("slot"),
        hash_unit(seed + 2, F.col("id")).alias("gap"),
        hash60(seed + 3, F.col("id")).alias("__h"))
    # neighbour vector per (vector, slot): both sides hold at most k rows per key
    nbv = distinct.select(F.col("vid").alias("nb"), F.col("v").alias("nv"))
    slot_vec = slots.join(nbv, "nb").select("__q", "__slot", "nv")
    # A vector repeated c times receives about n*c/m draws.  Vectors above
    # m/HOT_SHARE rows (at most HOT_SHARE of them, so a bounded broadcast)
    # spread their draws over salts, and only their k slot rows are copied.
    hot = distinct.where(F.col("c") * HOT_SHARE > m).select(
        F.col("vid").alias("__q"),
        F.greatest(F.lit(1), F.ceil(F.col("c") * F.lit(n / m) / F.lit(SALT_ROWS))).cast("long").alias("__ns"))
    hot = F.broadcast(spark.createDataFrame(hot.limit(HOT_SHARE + 1).collect(), hot.schema))
    ns = F.coalesce(F.col("__ns"), F.lit(1).cast("long"))
    slot_vec = (slot_vec.join(hot, "__q", "left")
                        .withColumn("__vsalt", F.explode(F.sequence(F.lit(0).cast("long"), ns - 1))).drop("__ns"))
    picked = (draws.join(ranked, "__idx")
                   .join(hot.withColumnRenamed("__q", "vid"), "vid", "left")
                   .withColumn("__salt", F.pmod(F.col("__h"), ns)))
    syn = picked.join(slot_vec, (F.col("vid") == F.col("__q")) & (F.col("slot") == F.col("__slot"))
                      & (F.col("__salt") == F.col("__vsalt"))).select(
        F.zip_with("v", "nv", lambda a, b: a + F.col("gap") * (b - a)).alias("x"))
    syn = syn.select(F.lit(None).cast(df.schema[key].dataType).alias(key),
                     *[F.col("x")[i].alias(c) for i, c in enumerate(features)],
                     F.lit(minority).cast(df.schema[target].dataType).alias(target), F.lit(1).alias("synthetic"))
    return base.unionByName(syn)
