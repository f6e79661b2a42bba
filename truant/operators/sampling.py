"""Exact, reproducible sampling: stratified split, k folds, up/down-sampling.

Randomness is a hash of (seed, key) so results do not depend on partitioning
and are reproducible in SQL.

A draw without replacement (split, down-sampling) takes the first ``quota``
rows of each stratum in hash order.  It only needs one border per stratum, the
pair (hash, key) of the last row taken.  One read counts the rows per stratum
and range of hash values, which gives the strata's sizes and the range in which
each border lies; a second one sorts that range's rows alone; the draw itself
is then a projection ``(hash, key) <= border`` of one scan, without a shuffle
of the rows.

Full ranks (folds, up-sampling) need the first of these reads, and shuffle
once: the counts give each range's offset, and only a range's own rows are
sorted together.

A null key is replaced by a hash of the whole row, so such rows are drawn like
others; rows that repeat a key share their place and stay on one side.
"""

from __future__ import annotations

import math
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from truant.functions.hashing import HASH_BITS, hash60
from truant.plans.joins import broadcast_if_small
from truant.schema import KEY, TARGET
from truant.session import local_frame, materialize

ROWS_PER_RANGE = 250_000  # rows sorted together, on average
MIN_RANGE_BITS = 8
HISTOGRAM_BITS = 16       # ranges that rows are counted in
#: Borders of so few strata are compared with in the rows' own expression, those of more are joined.
STRATA_IN_PLACE = 16
#: One count per stratum is held on the driver (some 100 bytes each).
MAX_STRATA = 1_000_000
_NULL = "\u0000null"
KEY_HASH = "__key_hash"


def _stratum(target: str):
    return F.coalesce(F.col(target).cast("string"), F.lit(_NULL))


class Counts(dict):
    """Rows per stratum.  ``ranges`` is the written table they are summed from:
    (__s, __f, __nb), the rows of each stratum in each of 2 ** ``bits`` ranges of hash values."""

    ranges: DataFrame
    bits: int
    nulls: bool


def _histogram(hashed: DataFrame, bits: int) -> Counts:
    """One read of the rows; everything else that needs counts reads the small written table."""
    ranges = materialize(hashed.groupBy("__s", F.shiftright("__h", HASH_BITS - bits).alias("__f")).agg(
        F.count(F.lit(1)).alias("__nb"), F.count_if(F.col("__null")).alias("__nulls")), "hash-ranges")
    rows = ranges.groupBy("__s").agg(F.sum("__nb").alias("n"), F.sum("__nulls").alias("nulls")).limit(MAX_STRATA + 1).collect()
    if len(rows) > MAX_STRATA:
        raise ValueError(f"more than {MAX_STRATA} strata")
    out = Counts({r["__s"]: r["n"] for r in rows})
    out.ranges, out.bits, out.nulls = ranges.drop("__nulls"), bits, any(r["nulls"] for r in rows)
    return out


def _null_key_text(columns: list[str]) -> Column:
    """What stands for a null key: a hash of the whole row."""
    return F.concat(F.lit("\u0000"), F.xxhash64(*columns).cast("string"))


def with_hash(df: DataFrame, key: str = KEY, seed: int = 42, out: str = KEY_HASH) -> DataFrame:
    """``df`` with the place of each row in the hash order of ``seed``.  Written with its table, the column can be
    given to :func:`select_by_quota` as ``hashed``, whose reads then need not work it out again."""
    return df.withColumn(out, hash60(seed, F.coalesce(F.col(key).cast("string"), _null_key_text(df.columns))))


def _counted(df: DataFrame, target: str, key: str, seed: int,
             rows_per_range: int = ROWS_PER_RANGE, written: str | None = None) -> tuple[DataFrame, Counts, int]:
    """(rows with stratum, key text, hash and range, counts, bits of a range).

    One read counts the rows in 2 ** HISTOGRAM_BITS ranges; the rows' own ranges
    are as much coarser as brings them to about ``rows_per_range`` rows.  Only
    if keys are null, whose hash needs all columns, or if even the finest ranges
    would hold more rows than that, are the rows counted once more.  ``written``
    names a column of ``df`` with the hashes, of null keys as well.
    """
    columns = [c for c in df.columns if c != written]

    def hashed(text: Column) -> DataFrame:
        rows = df.withColumns({"__s": _stratum(target), "__k": text, "__null": F.col(key).isNull()})
        return rows.withColumn("__h", F.col(written) if written else hash60(seed, F.coalesce("__k", F.lit(""))))

    text = F.col(key).cast("string")
    counts = _histogram(hashed(text), HISTOGRAM_BITS)
    bits = min(HASH_BITS, max(MIN_RANGE_BITS, math.ceil(math.log2(max(1, sum(counts.values()) / rows_per_range)))))
    if counts.nulls:
        text = F.coalesce(text, _null_key_text(columns))
    if (counts.nulls and not written) or bits > HISTOGRAM_BITS:
        counts = _histogram(hashed(text), max(bits, HISTOGRAM_BITS))
    return hashed(text).drop("__null").withColumn("__b", F.shiftright("__h", HASH_BITS - bits)), counts, bits


def _ranges(counts: Counts, bits: int) -> DataFrame:
    """(stratum, range) -> rows, start offset, for ranges of ``bits``.  The
    running sum is over one stratum's ranges, never over data rows."""
    stats = counts.ranges.groupBy("__s", F.shiftright("__f", counts.bits - bits).alias("__b")).agg(F.sum("__nb").alias("__nb"))
    w = Window.partitionBy("__s").orderBy("__b")
    return stats.withColumn("__start", F.sum("__nb").over(w) - F.col("__nb"))


def stratum_counts(df: DataFrame, target: str = TARGET) -> dict[str, int]:
    rows = (df.groupBy(_stratum(target).alias("s")).agg(F.count(F.lit(1)).alias("n"))
              .limit(MAX_STRATA + 1).collect())
    if len(rows) > MAX_STRATA:
        raise ValueError(f"more than {MAX_STRATA} strata in {target}")
    return {r["s"]: r["n"] for r in rows}


def allocate(counts: dict[str, int], size: float) -> dict[str, int]:
    """Per-stratum quotas summing to ``ceil(size * n)`` (or ``size`` rows when
    an integer): floors of the proportional shares, the remainder to the
    largest fractional parts (ties by stratum value)."""
    n = sum(counts.values())
    # decimal semantics for the fraction: ceil(0.2 * 10000) is 2000, not 2001
    total = int(size) if isinstance(size, int) and size >= 1 else math.ceil(Fraction(str(size)) * n)
    if total > n:
        raise ValueError(f"cannot draw {total} of {n} rows without replacement")
    shares = {s: Fraction(total * c, n) if n else Fraction(0) for s, c in counts.items()}
    base = {s: math.floor(v) for s, v in shares.items()}
    rest = total - sum(base.values())
    order = sorted(counts, key=lambda s: (-(shares[s] - base[s]), s))
    for s in order[:rest]:
        base[s] += 1
    return base


def _borders(h: DataFrame, counts: Counts, quotas: dict[str, int]) -> list[tuple[str, int, str]]:
    """(stratum, hash, key text) of the last row taken in each stratum that is drawn from.

    One read, of the columns that the hash needs: only the rows of the range
    in which a stratum's border lies go on."""
    spark = h.sparkSession
    wanted = [(s, int(q)) for s, q in quotas.items() if 0 < q < counts[s]]
    if not wanted:
        return []
    q = broadcast_if_small(local_frame(spark, wanted, __s=pa.string(), __q=pa.int64()), len(wanted))
    at = _ranges(counts, counts.bits).join(q, "__s").where("__start < __q and __q <= __start + __nb")
    at = at.select("__s", "__b", (F.col("__q") - F.col("__start")).alias("__nth")).collect()  # one a stratum
    at = broadcast_if_small(local_frame(spark, at, __s=pa.string(), __b=pa.int64(), __nth=pa.int64()), len(at))
    w = Window.partitionBy("__s").orderBy("__h", "__k")
    fine = F.shiftright("__h", HASH_BITS - counts.bits).alias("__b")
    last = h.select("__s", fine, "__h", "__k").join(at, ["__s", "__b"]).withColumn("__r", F.row_number().over(w))
    return [(r["__s"], r["__h"], r["__k"]) for r in last.where("__r = __nth").collect()]


def _taken(border_hash: Column, border_key: Column) -> Column:
    """Whether a row comes no later than its stratum's border."""
    return (F.col("__h") < border_hash) | ((F.col("__h") == border_hash) & (F.col("__k") <= border_key))


def select_by_quota(df: DataFrame, quotas, target: str = TARGET, key: str = KEY,
                    seed: int = 42, flag: str = "__in", rows_per_range: int = ROWS_PER_RANGE, hashed: str | None = None) -> DataFrame:
    """Add boolean ``flag``: row is among the first ``quota`` of its stratum in
    hash order (hash, then key).  ``quotas`` is a dict or a function of the
    stratum counts.  Rows that repeat the key of the last row taken are taken too.
    ``hashed``: a column of :func:`with_hash` by the same key and seed."""
    h, counts, _ = _counted(df, target, key, seed, rows_per_range, hashed)
    quotas = quotas(counts) if callable(quotas) else quotas
    borders = _borders(h, counts, {s: q for s, q in quotas.items() if s in counts})
    borders += [(s, 1 << HASH_BITS, "") for s, q in quotas.items() if 0 < counts.get(s, 0) <= q]  # whole strata
    if len(borders) <= STRATA_IN_PLACE:
        taken = F.lit(False)
        for s, bh, bk in borders:
            taken = F.when(F.col("__s") == s, _taken(F.lit(bh), F.lit(bk))).otherwise(taken)
        return h.select(*df.columns, taken.alias(flag))
    lut = broadcast_if_small(local_frame(df.sparkSession, borders, __s=pa.string(), __bh=pa.int64(), __bk=pa.string()), len(borders))
    taken = _taken(F.col("__bh"), F.col("__bk"))
    return h.join(lut, "__s", "left").select(*df.columns, F.coalesce(taken, F.lit(False)).alias(flag))


def class_rank(df: DataFrame, target: str = TARGET, key: str = KEY, seed: int = 42,
               out: str = "class_rank", rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """1-based rank of each row inside its stratum in hash order.

    One shuffle of the rows on (stratum, range), which the join to the offsets
    and the window share; a stratum holding a third of all rows is spread over
    its ranges.
    """
    return _ranked(df, *_counted(df, target, key, seed, rows_per_range), out)


def _ranked(df: DataFrame, h: DataFrame, counts: Counts, bits: int, out: str) -> DataFrame:
    w = Window.partitionBy("__s", "__b").orderBy("__h", "__k")
    ranked = h.join(_ranges(counts, bits).drop("__nb"), ["__s", "__b"])
    return ranked.select(*df.columns, (F.col("__start") + F.row_number().over(w)).alias(out))


# ------------------------------------------------------------------ splits
def stratified_split(df: DataFrame, target: str = TARGET, test_size: float = 0.2, seed: int = 42,
                     key: str = KEY, out: str = "split", hashed: str | None = None) -> DataFrame:
    """Add ``split`` = 'test' / 'train'; per-stratum test quotas are exact."""
    tagged = select_by_quota(df, lambda counts: allocate(counts, test_size), target, key, seed, "__in", hashed=hashed)
    return tagged.withColumn(out, F.when(F.col("__in"), "test").otherwise("train")).drop("__in")


def split_frames(df: DataFrame, target: str = TARGET, test_size: float = 0.2, seed: int = 42,
                 key: str = KEY) -> tuple[DataFrame, DataFrame]:
    s = stratified_split(df, target, test_size, seed, key)
    return (s.where(F.col("split") == "train").drop("split"),
            s.where(F.col("split") == "test").drop("split"))


def stratified_kfold(df: DataFrame, k: int = 5, target: str = TARGET, seed: int = 42,
                     key: str = KEY, out: str = "fold") -> DataFrame:
    """Fold = (rank - 1) mod k inside each stratum: sizes differ by <= 1 per
    stratum.  The column feeds ``CrossValidator(foldCol=...)``."""
    r = class_rank(df, target, key, seed, "__r")
    return r.withColumn(out, F.pmod(F.col("__r") - 1, F.lit(k)).cast("int")).drop("__r")


def split_check(df: DataFrame, split: str = "split", target: str = TARGET) -> DataFrame:
    """Rows and class share per split (the before/after check); the totals
    are sums over the grouped rows."""
    c = df.groupBy(split, target).agg(F.count(F.lit(1)).alias("count"))
    total = F.sum("count").over(Window.partitionBy(split))
    return c.withColumn("percentage", F.round(F.col("count") / total * 100, 2))


# -------------------------------------------------------------- resampling
def resample_guard(available: int, wanted: int, replace: bool) -> None:
    if not replace and wanted > available:
        raise ValueError(f"cannot take {wanted} rows from {available} without replacement")


def downsample(df: DataFrame, target: str = TARGET, key: str = KEY, seed: int = 123,
               majority=0, n: int | None = None) -> DataFrame:
    """Majority class drawn without replacement down to ``n`` rows (default:
    the size of the rest); other classes kept whole."""
    maj = str(majority)

    def quotas(counts):
        want = sum(v for s, v in counts.items() if s != maj) if n is None else n
        resample_guard(counts.get(maj, 0), want, False)
        return {s: (want if s == maj else v) for s, v in counts.items()}
    return select_by_quota(df, quotas, target, key, seed, "__in").where("__in").drop("__in")


def draw_partitions(n: int, rows: int = 4_000_000) -> int:
    """Tasks that generate ``n`` draws."""
    return max(1, -(-n // rows))


def upsample(df: DataFrame, target: str = TARGET, key: str = KEY, seed: int = 123,
             minority=1, n: int | None = None) -> DataFrame:
    """Minority class replaced by ``n`` draws with replacement (default: the
    size of the rest); other classes kept whole.

    Draw j (0..n-1) takes minority row number ``hash60(seed, j) mod m``.  The
    draws are generated by ``spark.range`` (distributed), pre-aggregated to
    (row number, copies) before the join, and copies are expanded after it.
    """
    mino = str(minority)
    h, counts, bits = _counted(df, target, key, seed)
    m = counts.get(mino, 0)
    n = sum(v for s, v in counts.items() if s != mino) if n is None else n
    if m == 0:
        raise ValueError("minority class is empty")
    draws = (df.sparkSession.range(0, n, 1, draw_partitions(n))
               .select(F.pmod(hash60(seed, F.col("id")), F.lit(m)).alias("__idx"))
               .groupBy("__idx").agg(F.count(F.lit(1)).alias("__copies")))
    ranked = _ranked(df, h.where(F.col("__s") == mino), counts, bits, "__r").withColumn("__idx", F.col("__r") - 1)
    picked = (ranked.join(draws, "__idx")
                    .withColumn("__rep", F.explode(F.array_repeat(F.lit(1), F.col("__copies").cast("int"))))
                    .drop("__idx", "__r", "__copies", "__rep"))
    rest = df.where(_stratum(target) != mino)
    return rest.unionByName(picked.select(*df.columns))
