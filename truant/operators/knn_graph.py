"""A neighbour graph refined by joins: approximate k-NN in many dimensions.

The neighbour of a neighbour is likely a neighbour.  Every vector starts with
the nearest of the vectors it shares a random cell with.  In each round

1. a vector gathers the vectors next to it, on either end of an edge (those
   that point to it are at most as many as its own, by hash), with their
   components and the distance beyond which they have no use for another;
2. all pairs in such a gathering, of which one member must be new there, are
   measured, and those within that distance become candidate edges;
3. of its old and candidate edges each vector keeps the ``degree`` nearest.

A gathering has 2 * degree members at most, so a round's work per vector does
not grow with their number.  The rounds end when less than ``least_change`` of
the edges changed.  Everything between rounds is a written table.

The result is approximate: recall is high where the data's own dimension is
moderate, and has to be measured (tests/test_knn_graph.py has figures for 20
independent dimensions).  :func:`truant.operators.smote.knn_distinct` is exact.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from truant.session import materialize, ship_package

DEGREE = 24
ROUNDS = 12
LEAST_CHANGE = 0.002
#: Vectors that are compared all with all at the start, and how many such cells a vector is in.
CELL, TABLES = 64, 3
EDGES = "q string, nb string, dist double"


def _matrix(lists: pa.Array) -> np.ndarray:
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(lists), -1) if len(lists) else np.zeros((0, 0))


def near_pairs(v: np.ndarray, reach: np.ndarray, new: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, distance) of the ordered pairs with a new member whose distance is under i's reach."""
    n = (v * v).sum(axis=1)
    d = np.sqrt(np.maximum(n[:, None] + n[None, :] - 2 * (v @ v.T), 0))
    use = (d < reach[:, None] * (1 + 1e-9)) & (new[:, None] | new[None, :])
    np.fill_diagonal(use, False)
    i, j = np.nonzero(use)
    return i, j, np.sqrt(((v[i] - v[j]) ** 2).sum(axis=1))  # exact: the product above loses digits


def _gatherings(most: int | None):
    """Rows (members: array of vid, v, reach, new) to edges; of each member the ``most`` nearest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes = np.asarray(b.column(0).value_lengths())
            members = b.column(0).flatten()
            ids = np.array(members.field("vid").to_pylist(), dtype=object)
            v = _matrix(members.field("v"))
            reach = members.field("reach").to_numpy(zero_copy_only=False)
            new = members.field("new").to_numpy(zero_copy_only=False)
            end, out = np.cumsum(sizes), ([], [], [])
            for lo, hi in zip(end - sizes, end, strict=True):
                i, j, d = near_pairs(v[lo:hi], reach[lo:hi], new[lo:hi])
                if most is not None and len(i):
                    order = np.lexsort((d, i))
                    i, j, d = i[order], j[order], d[order]
                    nth = np.arange(len(i)) - np.searchsorted(i, i)
                    i, j, d = i[nth < most], j[nth < most], d[nth < most]
                for col, x in zip(out, (ids[lo + i], ids[lo + j], d), strict=True):
                    col.append(x)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out[0]), pa.string()), pa.array(np.concatenate(out[1]), pa.string()),
                                                  pa.array(np.concatenate(out[2]))], ["q", "nb", "dist"])

    return run


def _nearest(edges: DataFrame, degree: int) -> DataFrame:
    """The ``degree`` nearest edges (q, nb, dist, new) of each vector; an edge found again stays old."""
    once = edges.groupBy("q", "nb").agg(F.min("dist").alias("dist"), F.min("new").alias("new"))
    nth = F.row_number().over(Window.partitionBy("q").orderBy("dist", "nb"))
    return once.withColumn("__nth", nth).where(F.col("__nth") <= degree).drop("__nth")


def _member(reach: Column, new: Column) -> Column:
    return F.struct("vid", "v", reach.cast("double").alias("reach"), new.cast("boolean").alias("new"))


def start_edges(vectors: DataFrame, n: int, degree: int, seed: int) -> DataFrame:
    """(q, nb, dist) inside random cells: the vectors are cut at the quantiles
    of a few random directions into cells of about CELL, crowded ones by hash."""
    rng = np.random.default_rng(seed)
    width = vectors.agg(F.max(F.size("v"))).first()[0]
    directions = 4
    bins = max(1, math.ceil((n / CELL) ** (1 / directions)))
    found = []
    for t in range(TABLES):
        lines = rng.standard_normal((directions, width))
        on = [F.aggregate(F.zip_with("v", F.array(*[F.lit(float(x)) for x in line]), lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x) for line in lines]
        placed = vectors.select("vid", "v", *[c.alias(f"p{i}") for i, c in enumerate(on)])
        if bins > 1:
            cuts = placed.agg(*[F.percentile_approx(f"p{i}", [j / bins for j in range(1, bins)]).alias(f"p{i}") for i in range(directions)]).first()
            cell = [sum(((F.col(f"p{i}") > F.lit(float(c))).cast("int") for c in cuts[i]), F.lit(0)) for i in range(directions)]
        else:
            cell = [F.lit(0)] * directions
        placed = placed.select("vid", "v", F.concat_ws(".", *[c.cast("string") for c in cell]).alias("cell"))
        parts = placed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / (2 * CELL)).alias("parts"))  # at most bins ** directions rows
        placed = placed.join(parts, "cell").withColumn("part", F.pmod(F.xxhash64("vid", F.lit(t)), "parts"))
        cells = placed.groupBy("cell", "part").agg(F.collect_list(_member(F.lit(float("inf")), F.lit(True))).alias("members"))
        found.append(cells.select("members").mapInArrow(_gatherings(degree), EDGES))
    out = found[0]
    for f in found[1:]:
        out = out.union(f)
    return out


def refine(vectors: DataFrame, graph: DataFrame, degree: int, seed: int) -> DataFrame:
    """One round: candidate edges (q, nb, dist) among the vectors that meet at a third."""
    reach = graph.groupBy("q").agg(F.count(F.lit(1)).alias("n"), F.max("dist").alias("dist")).select(
        F.col("q").alias("vid"), F.when(F.col("n") >= degree, F.col("dist")).otherwise(F.lit(float("inf"))).alias("reach"))
    known = vectors.select("vid", "v").join(reach, "vid", "left").withColumn("reach", F.coalesce("reach", F.lit(float("inf"))))
    draw = F.xxhash64("q", "nb", F.lit(seed))
    nth = F.row_number().over(Window.partitionBy("nb").orderBy(F.desc("new"), draw))
    back = graph.withColumn("__nth", nth).where(F.col("__nth") <= degree)
    ends = graph.select(F.col("q").alias("at"), F.col("nb").alias("vid"), "new").union(back.select(F.col("nb").alias("at"), F.col("q").alias("vid"), "new"))
    ends = ends.groupBy("at", "vid").agg(F.max("new").alias("new"))
    gathered = ends.join(known, "vid").groupBy("at").agg(F.collect_list(_member(F.col("reach"), F.col("new") == 1)).alias("members"))
    return gathered.select("members").mapInArrow(_gatherings(None), EDGES)


def knn_graph(vectors: DataFrame, k: int = 5, degree: int = DEGREE, rounds: int = ROUNDS, least_change: float = LEAST_CHANGE, seed: int = 42) -> DataFrame:
    """``vectors``: (vid string, v array<double>, c long multiplicity), vid unique.

    Returns (q, nb, dist, w) like ``smote.knn_distinct``: the k nearest rows that
    the graph knows for each vector, multiplicities counted, the vector itself
    excluded once.  Vectors have one length and no nulls.
    """
    from truant.operators.smote import CAND_SCHEMA, _trim
    spark = vectors.sparkSession
    ship_package(spark)
    n = vectors.count()
    if not n:
        return spark.createDataFrame([], CAND_SCHEMA)
    degree = max(degree, 2 * k)
    graph = materialize(_nearest(start_edges(vectors, n, degree, seed).withColumn("new", F.lit(1)), degree), "graph-0")
    for r in range(1, rounds + 1):
        found = refine(vectors, graph, degree, seed + r).withColumn("new", F.lit(1))
        graph = materialize(_nearest(graph.withColumn("new", F.lit(0)).unionByName(found), degree), f"graph-{r}")
        total, changed = graph.agg(F.count(F.lit(1)), F.coalesce(F.sum("new"), F.lit(0))).first()
        if changed <= least_change * total:
            break
    weights = vectors.select(F.col("vid").alias("nb"), F.col("c").alias("w"))
    own = vectors.where("c > 1").select(F.col("vid").alias("q"), F.col("vid").alias("nb"), F.lit(0.0).alias("dist"), (F.col("c") - 1).alias("w"))
    return _trim(graph.select("q", "nb", "dist").join(weights, "nb").select("q", "nb", "dist", "w").unionByName(own), k)
