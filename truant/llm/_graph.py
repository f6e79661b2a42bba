"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from truant.llm._common import keyed_join, written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step over ``edges`` (a, b), a > b.

    Large: every neighbour above a node moves to the least of the node and its
    neighbours.  Small: every neighbour below moves there, and so does the node.
    """
    pairs = written(edges.union(edges.select("b", "a")), "star") if large else edges
    least = written(pairs.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("deg")), "least")
    joined = keyed_join(pairs, least, ["a"], "deg")
    if large:
        out = joined.filter("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    return written(out.filter("a <> b").distinct(), "edges")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: long), root the least node of its component.

    Empty edges give an empty result; loops, repeated and reversed edges do no
    harm.  Each step is written to the shared folder, so a lost executor costs
    one step at most; the number of steps grows with the logarithm of the size.
    """
    now = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "edges")
    mark = None
    while True:
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % (1 << 31))).first()
        if seen[0] == 0 or seen == mark:
            break
        mark = seen
        now = _star(_star(now, large=True), large=False)
    nodes = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.union(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
