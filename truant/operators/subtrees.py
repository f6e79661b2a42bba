"""The part of a deep classification tree below the leaves of a shallow one.

A tree without a bound on its leaves grows with its rows: as one model it would
lie on the driver, and growing it level by level passes over all rows for each
group of nodes.  What selection asks of it are importances, which are sums over
its nodes.  So MLlib grows the top on all rows, and here every row of a leaf
that is not pure goes on with the leaf's number:

* values become bins, by borders from the exact weights of the values of all rows
  (midpoints of them all, or as MLlib cuts a sample of them);
* a leaf above ``local_rows`` rows is split by one pass that counts its rows by
  bin and class, again and again, until its parts are small;
* the rows of a small one meet in one task, which grows its subtree to the end.

Both take the split of greatest Gini gain by the same function on the same
counts, so that ``local_rows`` changes no result, and no row is left out.  As in
MLlib a split between two leaves of the same class is taken back, from below.
The driver holds the splits of leaves above ``local_rows`` and one row a subtree.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from truant.plans.joins import broadcast_if_small
from truant.plans.prefix import running_totals
from truant.session import local_frame, materialize, ship_package

LOCAL_ROWS = 500_000
#: Numbers of a table of counts that are looked at together.
CELLS = 1 << 20
#: Values whose running minimum one task works out.
VALUES_PER_RANGE = 1_000_000


# ---------------------------------------------------------------- borders
def value_weights(rows: DataFrame, weights: np.ndarray) -> DataFrame:
    """(feature, value, w): the weight of the rows with each value; ``rows`` are (x, label)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, list] = {}
        for b in batches:
            w = weights[b.column("label").to_numpy().astype(np.int64)]
            x = _matrix(b)
            for f in range(x.shape[1]):
                values, at = np.unique(x[:, f], return_inverse=True)
                seen.setdefault(f, []).append((values, np.bincount(at, w)))
        for f, parts in seen.items():
            values, at = np.unique(np.concatenate([v for v, _ in parts]), return_inverse=True)
            w = np.bincount(at, np.concatenate([w for _, w in parts]))
            for k in range(0, len(values), 65_536):
                v = values[k : k + 65_536]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(v), f, np.int32)), pa.array(v), pa.array(w[k : k + 65_536])], ["feature", "value", "w"])

    return rows.mapInArrow(run, "feature int, value double, w double").groupBy("feature", "value").agg(F.sum("w").alias("w"))


def borders(rows: DataFrame, n_features: int, weights: np.ndarray, max_bins: int) -> list[np.ndarray]:
    """Of each feature the least value of every bin but the first, in ascending order."""
    values = materialize(value_weights(rows, weights), "value-weights")
    sizes = {r["feature"]: (r["n"], r["w"]) for r in values.groupBy("feature").agg(F.count(F.lit(1)).alias("n"), F.sum("w").alias("w")).collect()}
    out = [np.empty(0)] * n_features
    whole = [f for f, (n, _) in sizes.items() if n <= max_bins]
    got: dict[int, list[float]] = {}
    for r in values.where(F.col("feature").isin(whole)).select("feature", "value").collect():
        got.setdefault(r["feature"], []).append(r["value"])
    for f, v in got.items():
        out[f] = np.sort(np.array(v))[1:]  # NaN, if there is one, is the greatest
    for f, (n, w) in sizes.items():
        if n > max_bins:
            out[f] = _cuts(values.where(F.col("feature") == f).select("value", "w"), n, w / max_bins)
    return out


def _cuts(values: DataFrame, n: int, stride: float, per_range: int = VALUES_PER_RANGE) -> np.ndarray:
    """MLlib's walk over the values in ascending order: value number i begins a bin if the next multiple of ``stride``
    is nearer to the weight before it than to the weight through it, and then the multiple after that is the next.

    Of the multiples below the middle of both weights, d, at most one a value is used up, so i - 1 begun bins are
    fewer than d unless d - i reaches no less than its least value before (or 0): the walk is a running minimum."""
    r = running_totals(values.withColumn("one", F.lit(1)), "value", ["w", "one"], n)
    i = F.col("cum_one") - 1
    d = F.ceil(F.round((F.col("cum_w") - F.col("w") / 2) / stride, 9)) - 1
    r = materialize(r.select("value", i.alias("i"), (d - i).alias("ahead"), F.floor(i / per_range).alias("range")).where("i > 0"), "value-walk")
    least = r.groupBy("range").agg(F.min("ahead").alias("least")).orderBy("range").collect()
    before = list(zip([x["range"] for x in least], accumulate([0, *(x["least"] for x in least)], min)))
    before = broadcast_if_small(local_frame(values.sparkSession, before, range=pa.int64(), before=pa.int64()), len(before))
    w = Window.partitionBy("range").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    walked = r.join(before, "range").withColumn("low", F.least("before", F.coalesce(F.min("ahead").over(w), F.lit(0))))
    return np.sort(np.array([x["value"] for x in walked.where("ahead >= low").select("value").collect()]))


# ------------------------------------------------------------------ splits
def _impurity(counts: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(weight, Gini impurity) of class counts in the last axis."""
    by_class = counts * weights
    total = by_class.sum(-1)
    share = by_class / np.maximum(total, 1e-300)[..., None]
    impurity = np.ones(total.shape)
    for c in range(share.shape[-1]):  # class by class as MLlib does, so that ties round alike
        impurity -= share[..., c] * share[..., c]
    return total, impurity


def best_of_feature(counts: np.ndarray, weights: np.ndarray, min_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(gain, last bin of the left side) of nodes' best split by a feature; ``counts``: (node, bin, class).  Gain 0: none."""
    if counts.shape[1] < 2:
        return np.zeros(len(counts)), np.zeros(len(counts), np.int64)
    left = counts.cumsum(1)
    total, left = left[:, -1], left[:, :-1]
    right = total[:, None] - left
    (w, imp), (lw, limp), (rw, rimp) = (_impurity(c, weights) for c in (total, left, right))
    w = np.maximum(w, 1e-300)[:, None]
    gain = imp[:, None] - lw / w * limp - rw / w * rimp
    gain[(left.sum(-1) < min_rows) | (right.sum(-1) < min_rows)] = 0.0
    at = gain.argmax(1)
    return np.maximum(gain[np.arange(len(gain)), at], 0.0), at


def _predicted(counts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return (counts * weights).argmax(-1)


def _open(counts: np.ndarray, depth_left: np.ndarray, min_rows: int) -> np.ndarray:
    """Whether nodes may be split: several classes, and levels and rows left."""
    return ((counts > 0).sum(-1) > 1) & (depth_left > 0) & (counts.sum(-1) >= 2 * min_rows)


def grow(x: np.ndarray, y: np.ndarray, roots: np.ndarray, depth_left: np.ndarray, bins: list[int], weights: np.ndarray,
         min_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(importances, whether it ended as a leaf) of the subtrees of all roots, level by level.

    ``x``: (feature, row) bins; ``roots``: the root of each row, ascending from 0; ``depth_left``: levels below each root.
    The importances are gains times the weight of the rows."""
    k, n_features, n_roots = len(weights), len(bins), len(depth_left)
    importance = np.zeros((n_roots, n_features))
    node, owner, left = roots.astype(np.int64), np.arange(n_roots), depth_left.astype(np.int64)
    counts = np.bincount(node * k + y, minlength=n_roots * k).reshape(-1, k)
    levels = []
    while len(owner):
        starts = np.concatenate([[0], np.cumsum(np.bincount(node, minlength=len(owner)))])
        gain, feature, cut = np.zeros(len(owner)), np.zeros(len(owner), np.int64), np.zeros(len(owner), np.int64)
        able = _open(counts, left, min_rows)
        for f, b in enumerate(bins):
            for a in range(0, len(owner) if b > 1 else 0, max(1, CELLS // (b * k))):
                z = min(len(owner), a + max(1, CELLS // (b * k)))
                s = slice(starts[a], starts[z])
                cells = np.bincount(((node[s] - a) * b + x[f, s]) * k + y[s], minlength=(z - a) * b * k).reshape(z - a, b, k)
                g, at = best_of_feature(cells, weights, min_rows)
                better = g > gain[a:z]
                gain[a:z][better], feature[a:z][better], cut[a:z][better] = g[better], f, at[better]
        split = able & (gain > 0)
        total = _impurity(counts, weights)[0]
        # both sides of split nodes, the left before the right
        number = np.cumsum(split) - 1
        on = split[node]
        node, y, x = node[on], y[on], x[:, on]
        side = number[node] * 2 + (x[feature[node], np.arange(len(node))] > cut[node])
        sides = np.bincount(side * k + y, minlength=2 * int(split.sum()) * k).reshape(-1, k)
        below = np.repeat(left[split] - 1, 2)
        goes_on = _open(sides, below, min_rows)
        child = np.where(goes_on, np.cumsum(goes_on) - 1, -1)
        levels.append((owner, split, feature, gain * total, child.reshape(-1, 2), _predicted(sides, weights).reshape(-1, 2)))
        on = goes_on[side]
        node, y, x = child[side[on]], y[on], x[:, on]
        order = np.argsort(node, kind="stable")
        node, y, x = node[order], y[order], x[:, order]
        owner, left, counts = np.repeat(owner[split], 2)[goes_on], below[goes_on], sides[goes_on]
    ended = np.zeros(0, bool)
    for owner, split, feature, gained, child, predicted in reversed(levels):
        leaf = child < 0
        leaf[~leaf] = ended[child[~leaf]]
        taken_back = leaf.all(1) & (predicted[:, 0] == predicted[:, 1])
        kept = split.copy()
        kept[split] = ~taken_back
        np.add.at(importance, (owner[kept], feature[kept]), gained[kept])
        ended = ~kept
    return importance, ended


# ------------------------------------------------------------------ tables
def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    """The array column ``x`` as (row, feature)."""
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _bytes(column: pa.Array, width: int, dtype) -> np.ndarray:
    """Binary values, of the same ``width`` bytes each, as (row, number)."""
    flat = np.frombuffer(b"".join(column.to_pylist()), dtype=dtype)
    return flat.reshape(len(column), width // np.dtype(dtype).itemsize)


_BINNED = pa.schema([("node", pa.int64()), ("y", pa.int32()), ("bins", pa.binary())])


def _binned(nodes: np.ndarray, y: np.ndarray, x: np.ndarray) -> pa.RecordBatch:
    """``x``: (row, feature), of which a row's numbers are written as bytes."""
    x = np.ascontiguousarray(x)
    width = x.shape[1] * x.itemsize
    offsets = pa.py_buffer(np.arange(len(x) + 1, dtype=np.int32) * np.int32(width))
    packed = pa.Array.from_buffers(pa.binary(), len(x), [None, offsets, pa.py_buffer(x.tobytes())])
    return pa.RecordBatch.from_arrays([pa.array(nodes.astype(np.int64)), pa.array(y.astype(np.int32)), packed], schema=_BINNED)


@dataclass
class _Split:
    """A node above the bound of one task: its split, or none."""
    node: int
    feature: int
    cut: int
    gain: float               # times the weight of the rows
    sides: tuple[int, int]
    predicted: tuple[int, int]


def importances(rows: DataFrame, n_features: int, leaves: dict[int, tuple[int, list[int]]], weights: list[float], max_bins: int = 128,
                min_rows: int = 1, local_rows: int = LOCAL_ROWS) -> np.ndarray:
    """Importances (gain times weight of the rows, by feature) of all that grows below the ``leaves``: leaf -> (levels
    left below it, rows by class).  ``rows``, read several times: (leaf, x: array of the features, label: class number);
    ``weights``: of the classes."""
    spark = rows.sparkSession
    ship_package(spark)
    w = np.asarray(weights, float)
    nodes = {int(n): (int(d), np.asarray(c, np.int64)) for n, (d, c) in leaves.items()}
    todo = {n for n, (d, c) in nodes.items() if _open(c, np.array(d), min_rows)}
    importance = np.zeros(n_features)
    if not todo:
        return importance
    edges = borders(rows.select("x", "label"), n_features, w, max_bins)
    bins = [len(e) + 1 for e in edges]
    dtype = np.uint8 if max(bins) <= 256 else np.int32
    width, k = n_features * np.dtype(dtype).itemsize, len(w)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.array(sorted(todo))
        for b in batches:
            leaf = b.column("leaf").to_numpy().astype(np.int64)
            on = np.isin(leaf, wanted)
            x = _matrix(b)[on]
            at = np.stack([np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(edges)], axis=1).astype(dtype)
            yield _binned(leaf[on], b.column("label").to_numpy()[on], at)

    table = materialize(rows.select("leaf", "x", "label").mapInArrow(deal, "node long, y int, bins binary"), "tree-bins")
    small, splits, new = [], [], max(nodes) + 1
    while True:
        large = sorted(n for n in todo if nodes[n][1].sum() > local_rows)
        small.append((table, sorted(todo - set(large))))
        if not large:
            break
        of_large = table.where(F.col("node").isin(large))
        todo, sides = set(), {}
        for s in _best_splits(of_large, bins, w, min_rows, width, dtype):
            pair = (new, new + 1)
            new += 2
            for side, c in zip(pair, s["sides"], strict=True):
                nodes[side] = (nodes[s["node"]][0] - 1, c)
                if _open(c, np.array(nodes[side][0]), min_rows):
                    todo.add(side)
            splits.append(_Split(s["node"], s["feature"], s["cut"], s["gain"], pair, tuple(int(_predicted(c, w)) for c in s["sides"])))
            sides[s["node"]] = splits[-1]
        if not todo:
            break
        table = materialize(of_large.mapInArrow(_dealer(sides, set(todo), width, dtype), "node long, y int, bins binary"), "tree-bins")

    ended = {}
    depths = {n: nodes[n][0] for _, part in small for n in part}
    parts = [t.where(F.col("node").isin(part)) for t, part in small if part]
    if parts:
        whole = parts[0]
        for p in parts[1:]:
            whole = whole.union(p)
        n_rows = sum(int(nodes[n][1].sum()) for n in depths)
        cores = spark.sparkContext.defaultParallelism
        tasks = min(len(depths), cores * max(1, -(-n_rows // (cores * local_rows))) * 4)
        grown = whole.repartition(tasks, "node").mapInArrow(_grower(depths, bins, w, min_rows, width, dtype), "node long, ended boolean, importance array<double>")
        for r in sorted(grown.collect(), key=lambda r: r["node"]):  # the same order, so the same sum, each time
            ended[r["node"]] = r["ended"]
            importance += np.array(r["importance"])
    for s in reversed(splits):
        leaf = [ended.get(n, True) for n in s.sides]
        ended[s.node] = all(leaf) and s.predicted[0] == s.predicted[1]
        if not ended[s.node]:
            importance[s.feature] += s.gain
    return importance


def _best_splits(rows: DataFrame, bins: list[int], w: np.ndarray, min_rows: int, width: int, dtype) -> list[dict]:
    """The nodes of ``rows`` that split: node, feature, cut, gain and the class counts of both sides."""
    k, first = len(w), np.concatenate([[0], np.cumsum(bins)])
    size = int(first[-1]) * k

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: dict[int, np.ndarray] = {}
        for b in batches:
            node, y, x = b.column("node").to_numpy(), b.column("y").to_numpy(), _bytes(b.column("bins"), width, dtype)
            for n in np.unique(node):
                on = node == n
                cells = got.setdefault(int(n), np.zeros(size, np.int64))
                cells += np.bincount(((first[:-1] + x[on]) * k + y[on, None]).ravel(), minlength=size)
        yield pa.RecordBatch.from_arrays([pa.array(list(got), pa.int64()), pa.array([c.tobytes() for c in got.values()], pa.binary())], ["node", "cells"])

    def best(table: pa.Table) -> pa.Table:
        cells = np.sum([np.frombuffer(c, np.int64) for c in table.column("cells").to_pylist()], axis=0).reshape(-1, k)
        gain, feature, cut, sides = 0.0, 0, 0, np.zeros((2, k), np.int64)
        for f in range(len(bins)):
            of_f = cells[first[f] : first[f + 1]]
            g, at = best_of_feature(of_f[None], w, min_rows)
            if g[0] > gain:
                gain, feature, cut = float(g[0]), f, int(at[0])
                sides = np.stack([of_f[: cut + 1].sum(0), of_f[cut + 1 :].sum(0)])
        gain *= float(_impurity(sides.sum(0), w)[0])
        return pa.table({"node": table.column("node")[:1], "feature": pa.array([feature], pa.int32()), "cut": pa.array([cut], pa.int32()),
                         "gain": pa.array([gain], pa.float64()), "sides": pa.array([sides.ravel().tolist()], pa.list_(pa.int64()))})

    got = rows.mapInArrow(count, "node long, cells binary").groupBy("node").applyInArrow(best, "node long, feature int, cut int, gain double, sides array<long>")
    return [{**r.asDict(), "sides": np.array(r["sides"]).reshape(2, k)} for r in got.where("gain > 0").orderBy("node").collect()]


def _dealer(splits: dict[int, _Split], open_sides: set[int], width: int, dtype):
    """Moves rows of split nodes to their sides, and leaves out those of sides that are done."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            node, y, x = b.column("node").to_numpy(), b.column("y").to_numpy(), _bytes(b.column("bins"), width, dtype)
            to = np.full(len(node), -1, np.int64)
            for n in np.unique(node):
                s = splits.get(int(n))
                if s is not None:
                    on = node == n
                    right = x[on, s.feature] > s.cut
                    to[on] = np.where(right, *((side if side in open_sides else -1) for side in reversed(s.sides)))
            on = to >= 0
            yield _binned(to[on], y[on], x[on])
    return run


def _grower(depths: dict[int, int], bins: list[int], w: np.ndarray, min_rows: int, width: int, dtype):
    """The subtrees of a task's nodes, one row each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(b.column("node").to_numpy(), b.column("y").to_numpy(), _bytes(b.column("bins"), width, dtype)) for b in batches if b.num_rows]
        if not parts:
            return
        node, y = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
        x = np.concatenate([p[2] for p in parts]).T
        del parts
        order = np.argsort(node, kind="stable")
        names, roots = np.unique(node[order], return_inverse=True)
        got, ended = grow(np.ascontiguousarray(x[:, order]), y[order].astype(np.int64), roots, np.array([depths[int(n)] for n in names]), bins, w, min_rows)
        yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(ended), pa.array(got.tolist(), pa.list_(pa.float64()))], ["node", "ended", "importance"])
    return run


def leaf_depths(debug: str) -> list[int]:
    """The depths of a tree's leaves in the order of MLlib's numbers for them, from its ``toDebugString``."""
    return [len(line) - len(line.lstrip()) - 2 for line in debug.split("\n") if line.lstrip().startswith("Predict:")]


def impurity_of(counts: list[list[int]], weights: list[float]) -> float:
    """The sum over nodes of their Gini impurity times their weight."""
    total, gini = _impurity(np.asarray(counts), np.asarray(weights, float))
    return math.fsum((total * gini).tolist())
