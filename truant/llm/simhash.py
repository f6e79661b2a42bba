"""SimHash near-duplicate groups, linked through tables of distances to pivots.

Every document gets a 64-bit fingerprint.  For each distinct fingerprint a
table of Hamming distances to fixed reference fingerprints (the pivots) is
computed once.  By the triangle inequality two fingerprints within ``r`` bits
differ by at most ``r`` in every coordinate of that table, so a pair with a
larger coordinate difference is discarded without looking at its bits; what
survives is verified by its true distance.

Pairs are only looked at inside blocks: the 64 bits are cut into ``r + 1``
segments, and two fingerprints within ``r`` bits agree on one segment whole.
No pair is written: a block gives a forest of its links.  A block with more
than ``max_block`` fingerprints is linked through shared one-bit variants of
its members instead (exact for ``r = 2`` and linear in the block).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from truant.llm._common import keyed_join, written
from truant.llm._graph import components

N_PIVOTS = 16
MAX_BLOCK = 512


def pivots(n: int = N_PIVOTS) -> list[int]:
    """Reference fingerprints: hashes of 0, 1, 2, ... (signed, as Spark stores them)."""
    out = [xxhash.xxh64_intdigest(i.to_bytes(8, "little"), 7) for i in range(n)]
    return [x - (1 << 64) if x >> 63 else x for x in out]


def fingerprint(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """Majority bits of the XXH64 of all word shingles; no word gives 0."""
    words = text.lower().split()  # of bytes: A-Z and [\x20\x09-\x0D] only
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return digest(joined, seed)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    lo, hi = starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist()
    n, ones = len(lo), np.zeros(64, np.int64)
    for k in range(0, n, 8192):
        h = np.fromiter((digest(joined[a:b], seed) for a, b in zip(lo[k : k + 8192], hi[k : k + 8192], strict=True)), "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, fp: long) for every row; null text counts as empty, a null id stays null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [fingerprint(t or b"", shingle, seed) for t in (x.as_py() for x in b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.array(fps, np.uint64).view(np.int64))], ["doc_id", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def _segments(r: int) -> list[tuple[int, int]]:
    cuts = [64 * i // (r + 1) for i in range(r + 2)]
    return list(zip(cuts, cuts[1:], strict=False))


def _mask(lo: int, hi: int) -> int:
    m = ((1 << (hi - lo)) - 1) << lo
    return m - (1 << 64) if m >> 63 else m


def block_forest(block: np.ndarray, fp: np.ndarray, table: np.ndarray, r: int) -> list[tuple[int, int]]:
    """Links (i, j) that connect all members of each block within ``r`` bits of each other.

    ``block`` numbers each member's block, ``table`` holds its pivot distances.
    Candidates come from a sweep along the first coordinate; the other
    coordinates discard them one by one, and the true distance decides on the
    rest.
    """
    at = block.astype(np.int64) * 256 + table[:, 0]  # blocks lie further apart than any distance
    order = np.argsort(at, kind="stable")
    at = at[order]
    reach = np.searchsorted(at, at + r, side="right") - np.arange(len(fp)) - 1
    i = np.repeat(np.arange(len(fp)), reach)
    j = np.arange(len(i)) - np.repeat(np.cumsum(reach) - reach, reach) + i + 1
    i, j = order[i], order[j]
    for c in range(1, table.shape[1]):
        x, y = table[i, c], table[j, c]
        near = np.maximum(x, y) - np.minimum(x, y) <= r
        i, j = i[near], j[near]
    near = np.bitwise_count(fp[i] ^ fp[j]) <= r
    parent = list(range(len(fp)))
    out = []
    for a, b in zip(i[near].tolist(), j[near].tolist(), strict=True):
        x, y = a, b
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        while parent[y] != y:
            parent[y] = y = parent[parent[y]]
        if x != y:
            parent[y] = x
            out.append((a, b))
    return out


def _block_links(r: int):
    """Rows (seg, val, fp, pivot distances), sorted by block, to links."""

    def out(rows: np.ndarray, number: np.ndarray) -> pa.RecordBatch:
        found = block_forest(number, rows[:, 2].view(np.uint64), np.ascontiguousarray(rows[:, 3:]).view(np.uint8), r)
        ends = np.array(found, np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(rows[ends[:, 0], 2]), pa.array(rows[ends[:, 1], 2])], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None  # the last block of a batch may go on in the next
        for batch in batches:
            rows = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            rows = rows if rest is None else np.concatenate([rest, rows])
            number = np.concatenate(([0], np.cumsum((rows[1:, :2] != rows[:-1, :2]).any(axis=1))))
            whole = number < number[-1]
            rest = rows[~whole]
            if whole.any():
                yield out(rows[whole], number[whole])
        if rest is not None and len(rest):
            yield out(rest, np.zeros(len(rest), np.int64))

    return run


def links(fps: DataFrame, r: int = 2, max_block: int = MAX_BLOCK) -> DataFrame:
    """(a, b): a forest over the distinct fingerprints ``fps`` (fp) that joins all within ``r`` bits."""
    if r != 2:
        max_block = 1 << 30  # the shared variants below hold for two bits
    dist = [F.bit_count(F.col("fp").bitwiseXOR(F.lit(p))).cast("long") for p in pivots()]
    packed = []
    for k in range(0, N_PIVOTS, 8):
        c = dist[k]
        for i, d in enumerate(dist[k + 1 : k + 8], 1):
            c = c.bitwiseOR(F.shiftleft(d, 8 * i))
        packed.append(c.alias(f"t{k // 8}"))
    segs = _segments(r)
    tables = [f"t{k // 8}" for k in range(0, N_PIVOTS, 8)]
    value = F.array(*[F.struct(F.lit(s).cast("long").alias("seg"), F.col("fp").bitwiseAND(F.lit(_mask(*b))).alias("val")) for s, b in enumerate(segs)])
    rows = written(fps.select("fp", *packed).select("fp", *tables, F.inline(value)).select("seg", "val", "fp", *tables), "blocks")
    sizes = written(rows.groupBy("seg", "val").agg(F.count("*").alias("size")).filter("size > 1"), "sizes")
    blocks = written(keyed_join(rows, sizes, ["seg", "val"], "size"), "sized")
    n = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    small = (blocks.filter(F.col("size") <= max_block).select("seg", "val", "fp", *tables)
             .repartition(n, "seg", "val").sortWithinPartitions("seg", "val").mapInArrow(_block_links(r), "a long, b long"))
    if not blocks.filter(F.col("size") > max_block).head(1):
        return small
    flips = F.concat(F.array(F.col("fp")), *[
        F.when(F.col("seg") == s, F.array(*[F.col("fp").bitwiseXOR(F.lit(_mask(i, i + 1))) for i in range(64) if not lo <= i < hi]))
        .otherwise(F.array().cast("array<bigint>")) for s, (lo, hi) in enumerate(segs)])
    shared = (blocks.filter(F.col("size") > max_block).select("seg", "fp", F.explode(flips).alias("variant"))
              .groupBy("seg", "variant").agg(F.collect_list("fp").alias("fps"))  # at most 1 + 43 distinct fingerprints have a variant
              .filter(F.size("fps") > 1).select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).filter("a <> b"))
    return small.union(shared)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    max_bits: int = 2, seed: int = 42, max_block: int = MAX_BLOCK) -> DataFrame:
    """(doc_id, fp, fingerprint, component_id), one row per row of ``docs``.

    Nulls: a null text is an empty one (fingerprint 0, linked like any other); a
    row with a null id keeps its fingerprint and links others, but is never a
    component's id: component_id is the least non-null id reachable, null if
    there is none.  Repeated rows stay repeated.  An empty table gives an empty
    result.  Other columns of ``docs`` are not read.
    """
    fp = written(fingerprints(docs, id_col, text_col, shingle, seed), "fingerprints")
    groups = written(fp.groupBy("fp").agg(F.count("*").alias("n"), F.min("doc_id").alias("least_id")), "fingerprint-groups")
    roots = components(links(groups.select("fp"), max_bits, max_block)).select(F.col("node").alias("fp"), "root")
    rooted = written(groups.join(roots, "fp", "left").select("fp", "n", "least_id", F.coalesce("root", "fp").alias("root")), "rooted")
    comps = written(rooted.groupBy("root").agg(F.min("least_id").alias("component_id"), F.count("*").alias("members")), "components")
    named = written(keyed_join(rooted.select("fp", "n", "root"), comps, ["root"], "members").select("fp", "n", "component_id"), "named")
    return keyed_join(fp, named, ["fp"], "n").select(
        "doc_id", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """Rows of ``docs`` (all columns) that stay: of each group the row with the least id.

    Of repeated rows with that id one stays; rows with a null id all stay.
    """
    stay = written(near_duplicates(docs, id_col, **options).filter("doc_id = component_id").select(F.col("doc_id").alias("__keep")).distinct(), "keep")
    from pyspark.sql import Window
    one = docs.join(stay, F.col(id_col) == F.col("__keep")).withColumn(
        "__nth", F.row_number().over(Window.partitionBy("__keep").orderBy("__keep")))
    return one.filter("__nth = 1").select(docs.columns).union(docs.filter(F.col(id_col).isNull()))
