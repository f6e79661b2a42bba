"""Document fingerprints by invertible Bloom lookup sketches of paragraph digests.

A paragraph is a part of a line of at least PARAGRAPH characters, up to the end
of a sentence (a shorter rest of the line is one too), its digest the first 60
bits of its MD5.  A sketch has three rows of cells; a digest is in one cell of
each, and a cell keeps the number of its digests, their XOR and the XOR of
their check values.  The cells of two versions are subtracted one by one, so
that what both have goes out.  A cell left with one digest, which its check value
shows, gives that digest away; it is taken out of its other cells, which may
leave single digests there, and so on until the sketch is empty: then all
differing digests are known.

The fingerprint is the sketch of 3 x WIDTH cells.  Where it doesn't peel, a
larger one is tried: the digests are dealt to parts by their leading bits, as
many parts as both counts call for, and each part that doesn't peel has its
width doubled, with other bits of the digest, until it does.  A part's cells
are counted from the digests of both versions at once, with their signs, which
gives the difference of the two sketches without the cells that cancel.

All of it is columns and higher-order functions: a pair of texts is compared
in its row, and nothing but texts is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PARAGRAPH = 120
PARAGRAPHS = rf"[^\r\n]{{1,{PARAGRAPH}}}[^.!?\r\n]*[.!?]*"
#: Cells in a row of the fingerprint, and the binary logarithm of that; the last width tried.
WIDTH, FIRST_EXP, LAST_EXP = 8, 3, 10
BITS = 60
#: Differing digests expected in a part.
PART = 10
CHECK_PRIME = 2_147_483_629
BUCKETS_A_PARTITION = 4

FOUND = "array<struct<key: bigint, n: int>>"
ENTRIES = "array<struct<key: bigint, n: int, p0: int, p1: int, p2: int>>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def digests(text: Column) -> Column:
    """Distinct 60-bit digests of a text's paragraphs."""
    parts = F.regexp_extract_all(text, F.lit(PARAGRAPHS), F.lit(0))
    return F.array_distinct(F.transform(parts, lambda p: F.conv(F.substring(F.md5(p.cast("binary")), 1, BITS // 4), 16, 10).cast("long")))


def check(key: Column) -> Column:
    return key % F.lit(CHECK_PRIME)


def signed(keys: Column, n: int = 1) -> Column:
    """An array of digests as (key, n)."""
    return F.transform(keys, lambda k: F.struct(k.alias("key"), F.lit(n).alias("n")))


def _shift(name: str, value: Column, bits: Column) -> Column:
    return F.call_function(name, value, bits)


def placed(entry: Column, exp: Column) -> Column:
    """(key, n) with its cell in each of the three rows of ``2 ** exp`` cells; another width takes other bits of the digest."""
    last = _shift("shiftleft", F.lit(1).cast("long"), exp) - F.lit(1).cast("long")
    first = F.lit(3) * (exp - F.lit(FIRST_EXP))
    rows = [(F.lit(row) * (last.cast("int") + F.lit(1)) + _shift("shiftright", entry["key"], first + F.lit(10 * row)).bitwiseAND(last).cast("int")).alias(f"p{row}")
            for row in range(3)]
    return F.struct(entry["key"].alias("key"), entry["n"].alias("n"), *rows)


def _in_cell(entry: Column, cell: Column) -> Column:
    return (entry["p0"] == cell) | (entry["p1"] == cell) | (entry["p2"] == cell)


def _less(c: Column, e: Column) -> Column:
    """A cell without an entry."""
    return F.struct((c["n"] - e["n"]).alias("n"), c["key"].bitwiseXOR(e["key"]).alias("key"), c["check"].bitwiseXOR(check(e["key"])).alias("check"))


def sketch(entries: Column, exp: Column | int = FIRST_EXP) -> Column:
    """The cells (n, key, check) of an array of (key, n), row by row."""
    exp = F.lit(exp) if isinstance(exp, int) else exp
    none = F.struct(F.lit(0).alias("n"), F.lit(0).cast("long").alias("key"), F.lit(0).cast("long").alias("check"))
    add = lambda c, e: F.struct((c["n"] + e["n"]).alias("n"), c["key"].bitwiseXOR(e["key"]).alias("key"), c["check"].bitwiseXOR(check(e["key"])).alias("check"))
    return let(F.transform(entries, lambda e: placed(e, exp)), lambda all_: F.transform(
        F.sequence(F.lit(0), F.lit(3) * _shift("shiftleft", F.lit(1), exp) - F.lit(1)),
        lambda c: F.aggregate(F.filter(all_, lambda e: _in_cell(e, c)), none, add)))


def subtract(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: F.struct(
        (x["n"] - y["n"]).alias("n"), x["key"].bitwiseXOR(y["key"]).alias("key"), x["check"].bitwiseXOR(y["check"]).alias("check")))


def _single(cells: Column, exp: Column) -> Column:
    """Digests that are alone in a cell, with their side (n is 1 or -1) and their cells."""
    alone = F.filter(cells, lambda c: (F.abs(c["n"]) == 1) & (c["check"] == check(c["key"])))
    return F.array_distinct(F.transform(alone, lambda c: placed(c, exp)))


def peel(cells: Column, exp: Column | int = FIRST_EXP) -> Column:
    """The digests (key, n) that a difference of sketches holds, null if it doesn't peel."""
    exp = F.lit(exp) if isinstance(exp, int) else exp

    def without(cells: Column, single: Column) -> Column:
        return F.transform(cells, lambda c, i: F.aggregate(F.filter(single, lambda e: _in_cell(e, i)), c, _less))

    def state(cells: Column, found: Column, single: Column) -> Column:
        return F.struct(cells.alias("cells"), found.alias("found"), single.alias("single"))

    def step(s: Column, _: Column) -> Column:
        after = let(without(s["cells"], s["single"]), lambda left: state(left, F.concat(s["found"], s["single"]), _single(left, exp)))
        return F.when(F.size(s["single"]) == 0, s).otherwise(after)

    def result(s: Column) -> Column:
        empty = F.forall(s["cells"], lambda c: (c["n"] == 0) & (c["key"] == 0))
        return F.when(empty, F.transform(s["found"], lambda e: F.struct(e["key"].alias("key"), e["n"].alias("n"))))

    start = let(cells, lambda c: state(c, F.array().cast(ENTRIES), _single(c, exp)))
    return F.aggregate(F.sequence(F.lit(1), F.lit(3) * _shift("shiftleft", F.lit(1), exp)), start, step, result)


def _grown(entries: Column) -> Column:
    """What is left of signed digests (key, n), by sketches of doubled widths until one peels."""

    def attempt(found: Column, exp: Column) -> Column:
        return F.when(found.isNotNull(), found).otherwise(peel(sketch(entries, exp), exp))

    return let(peel(sketch(entries)), lambda found: F.when(found.isNotNull(), found).otherwise(
        F.aggregate(F.sequence(F.lit(FIRST_EXP + 1), F.lit(LAST_EXP)), F.lit(None).cast(FOUND), attempt)))


def _leading(key: Column, bits: Column) -> Column:
    return _shift("shiftright", key, F.lit(BITS) - bits)


def _in_parts(a: Column, b: Column) -> Column:
    """Differing digests by a sketch in parts, as many as both counts call for; dealt in two steps, so that long arrays are read few times."""
    bits = F.round(F.log2(F.greatest((F.size(a) + F.size(b)) / F.lit(float(PART)), F.lit(1.0)))).cast("int")

    def one_of(width: Column) -> Column:
        return _shift("shiftleft", F.lit(1), width) - F.lit(1)

    def groups(all_bits: Column, entries: Column) -> Column:
        return let(F.floor(all_bits / 2).cast("int"), lambda high: F.flatten(F.transform(F.sequence(F.lit(0), one_of(high)), lambda g: let(
            F.filter(entries, lambda e: _leading(e["key"], high) == g), lambda own: parts(own, all_bits, high, g)))))

    def parts(own: Column, all_bits: Column, high: Column, g: Column) -> Column:
        first = _shift("shiftleft", g, all_bits - high)
        return F.flatten(F.transform(F.sequence(first, first + one_of(all_bits - high)), lambda p: let(
            F.filter(own, lambda e: _leading(e["key"], all_bits) == p), _grown)))

    return let(F.struct(bits.alias("bits"), F.concat(signed(a), signed(b, -1)).alias("entries")), lambda x: groups(x["bits"], x["entries"]))


def difference(a: Column, b: Column, a_cells: Column, b_cells: Column) -> Column:
    """The digests (key, n) that only ``a`` (n = 1) or only ``b`` (n = -1) has: fingerprints first, then larger sketches.

    What never peels (digests alike in all bits that choose cells) is told by comparing the arrays.
    """
    direct = F.concat(signed(F.array_except(a, b)), signed(F.array_except(b, a), -1))
    return let(peel(subtract(a_cells, b_cells)), lambda d: F.when(d.isNotNull(), d).otherwise(
        let(_in_parts(a, b), lambda d: F.when(d.isNotNull(), d).otherwise(direct))))


def likeness(a: Column, b: Column, differing: Column) -> Column:
    """Share of paragraphs that two texts have in common, by the number that differ; two texts without any are alike."""
    n = F.size(a) + F.size(b)
    return F.when(n == 0, F.lit(1.0)).otherwise((n - differing) / n)


def as_text(cells: Column) -> Column:
    return F.array_join(F.transform(cells, lambda c: F.concat_ws(":", c["n"].cast("string"), F.hex(c["key"]), F.hex(c["check"]))), " ")


def compare(pairs: DataFrame, a: str, b: str, prefix: str = "") -> DataFrame:
    """``pairs`` with the columns removed, added (digests of paragraphs that only ``a``, only ``b`` has) and likeness.

    Null texts are empty.  The names may be given a ``prefix`` where they clash.
    """
    names = {x: f"__iblt_{x}" for x in ("a", "b", "a_cells", "b_cells", "d")}
    out = pairs.withColumns({names["a"]: digests(F.coalesce(a, F.lit(""))), names["b"]: digests(F.coalesce(b, F.lit("")))})
    out = out.withColumns({names["a_cells"]: sketch(signed(F.col(names["a"]))), names["b_cells"]: sketch(signed(F.col(names["b"])))})
    out = out.withColumn(names["d"], difference(*[F.col(names[x]) for x in ("a", "b", "a_cells", "b_cells")]))
    side = lambda n: F.transform(F.filter(names["d"], lambda k: k["n"] == n), lambda k: k["key"])
    return out.withColumns({f"{prefix}removed": side(1), f"{prefix}added": side(-1),
                            f"{prefix}likeness": likeness(F.col(names["a"]), F.col(names["b"]), F.size(names["d"]))}).drop(*names.values())


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carried: dict[str, Callable[[Column], Column]] | None = None) -> DataFrame:
    """(doc_id, text, next_text, and ``carried`` columns of the text with their next_ counterparts): next by descending id, after the last the first.

    The ids are cut into ranges at their quantiles; a range also gets the first
    row of the range after it, so that each range knows its rows' successors
    and texts are shuffled once.  Rows of one id are neighbours, by their text.
    """
    spark = docs.sparkSession
    carried = carried or {}
    rows = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ranges = BUCKETS_A_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = rows.agg(F.percentile_approx("doc_id", [i / ranges for i in range(1, ranges)], 10 * ranges)).first()[0] or []
    cuts = sorted(set(cuts))
    bucket = F.lit(0)
    if cuts:
        steps = F.array(*[F.lit(1 << e) for e in reversed(range(len(cuts).bit_length()))])
        borders = F.lit(cuts)
        bucket = F.aggregate(steps, F.lit(0), lambda lo, p: F.when(
            (lo + p <= len(cuts)) & (F.get(borders, lo + p - 1) < F.col("doc_id")), lo + p).otherwise(lo))
    rows = rows.withColumn("bucket", bucket)
    greatest = {r.bucket: r.greatest for r in rows.groupBy("bucket").agg(F.max("doc_id").alias("greatest")).collect()}
    present = sorted(greatest)
    after = {b: present[(i + 1) % len(present)] for i, b in enumerate(present)}  # its last row's next one is the first of this range
    first_of = F.lit([greatest.get(b, 0) for b in range(len(cuts) + 1)])
    goes_to = F.lit([after.get(b, 0) for b in range(len(cuts) + 1)])
    copies = F.when(F.get(first_of, F.col("bucket")) == F.col("doc_id"), F.array(
        F.struct(F.col("bucket").alias("range"), F.lit(False).alias("copy")), F.struct(F.get(goes_to, F.col("bucket")).alias("range"), F.lit(True).alias("copy")))).otherwise(
        F.array(F.struct(F.col("bucket").alias("range"), F.lit(False).alias("copy"))))
    dealt = rows.select("doc_id", "text", F.inline(copies)).repartition("range")
    for name, make in carried.items():
        dealt = dealt.withColumn(name, make(dealt))
    order = Window.partitionBy("range").orderBy("copy", F.desc("doc_id"), "text")
    names = ["text", *carried]
    led = dealt.select("doc_id", "copy", *names, *[F.lead(c).over(order).alias(f"next_{c}") for c in names])
    return led.filter(~F.col("copy")).drop("copy")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, paragraphs) of every row.

    The edited text has the last half of the code points replaced by the first
    ones of the next document, in descending order of id.  Nulls: a null text
    is empty; a row with a null id has no place in that order, so that its next
    document is empty.  Repeated rows stay repeated, and one may be the other's
    next.  A repeated paragraph counts once; texts without paragraphs are alike.
    An empty table gives an empty result.  Other columns are not read.
    """
    ringed = with_next(docs, id_col, text_col, {"own": lambda d: digests(d["text"]), "cells": lambda d: sketch(signed(d["own"]))})
    lone = docs.filter(F.col(id_col).isNull()).select(F.lit(None).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    lone = lone.withColumns({"own": digests(F.col("text")), "next_text": F.lit(""), "next_own": F.array().cast("array<bigint>")})
    lone = lone.withColumns({f"{p}cells": sketch(signed(F.col(f"{p}own"))) for p in ("", "next_")})
    rows = _edited(ringed.unionByName(lone)).withColumn("edited_cells", sketch(signed(F.col("edited_own"))))
    near = {p: difference(F.col("own"), F.col(f"{p}_own"), F.col("cells"), F.col(f"{p}_cells")) for p in ("edited", "next")}
    return rows.select("doc_id", "n_chars", "edited_sha256", as_text(F.col("cells")).alias("fingerprint"), as_text(F.col("edited_cells")).alias("edited_fingerprint"),
                       *[likeness(F.col("own"), F.col(f"{p}_own"), F.size(d)).alias(f"near_{p}") for p, d in near.items()], F.size("own").alias("paragraphs"))


def _edited(rows: DataFrame) -> DataFrame:
    """``rows`` with the edited text's hash and digests instead of the texts."""
    half = F.floor(F.length("text") / 2).cast("int")
    text = F.concat(F.substring(F.col("text"), F.lit(1), F.length("text") - half), F.substring(F.col("next_text"), F.lit(1), half))
    rows = rows.withColumns({"edited": text, "n_chars": F.length("text").cast("long")})
    return rows.withColumns({"edited_sha256": F.sha2("edited", 256), "edited_own": digests(F.col("edited"))}).drop("edited", "text", "next_text")
