"""Benchmark decontamination: size-partitioned MinHash containment search, DataFrame operations only.

An item is contained in a document if at least ``threshold`` of the item's
distinct word shingles occur in it.  Items are short and documents are long, so
the sketch sits on the item's side (containment MinHash): an item's MinHash
sketch is the set of its ``k`` least shingle hashes, and each entry is looked
up among all shingle hashes of a document.

Items are partitioned by size, in classes that grow by the factor 2 ** 0.5; a
class has its own ``k``, from its largest size u: as an item may miss
u - ceil(threshold * u) shingles, a sketch with ``slack`` entries more than
that keeps every containing document, which meets at least as many entries as
the sketch has beyond the misses allowed.  So the search loses nothing, and
fewer hits rule a document out.  Candidates are then verified on the shingles
themselves.

Words are runs of letters and digits, lower-cased.  An item with fewer words
than ``shingle`` is one shingle of that many words; an item without words is
found nowhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from truant.llm._common import written

SHINGLE = 5
THRESHOLD = 0.8
SLACK = 3
#: The index of items is broadcast up to this many rows (some 60 MB); a larger one is joined by a shuffle.
MAX_BROADCAST_ROWS = 500_000


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def _hashes(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def _starts(n: Column, length: int) -> Column:
    """explode() of it gives the start of every shingle; no row for a text that is too short."""
    return F.when(n >= length, F.sequence(F.lit(0), n - F.lit(length)))


def _at(array: str, length: int) -> list[Column]:
    return [F.get(F.col(array), F.col("at") + F.lit(i)) for i in range(length)]


def shingle_hash(array: str, length: int) -> Column:
    return F.xxhash64(F.lit(length), *_at(array, length))


def item_shingles(items: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(item_id, length, shingle, hash, n): the distinct shingles of each item, n of them."""
    base = items.select(F.col(id_col).alias("item_id"), words(F.col(text_col)).alias("w")).filter("item_id is not null and size(w) > 0")
    base = base.withColumn("length", F.least(F.size("w"), F.lit(shingle))).withColumn("h", F.transform("w", lambda w: F.xxhash64(w)))
    at = base.select("item_id", "length", "w", "h", F.explode(F.sequence(F.lit(0), F.size("w") - F.col("length"))).alias("at"))
    text = F.concat_ws(" ", F.slice("w", F.col("at") + 1, F.col("length")))
    hashed = F.lit(None).cast("long")
    for k in range(1, shingle + 1):
        hashed = F.when(F.col("length") == k, shingle_hash("h", k)).otherwise(hashed)
    rows = at.select("item_id", "length", text.alias("shingle"), hashed.alias("hash")).distinct()
    sizes = rows.groupBy("item_id").agg(F.count("*").alias("n"))
    return rows.join(sizes, "item_id")


def sketches(shingles: DataFrame, threshold: float = THRESHOLD, slack: int = SLACK) -> DataFrame:
    """(item_id, hash, size_class, need): the least hashes of each item and how many of them a document must have."""
    needed = F.ceil(F.col("n") * F.lit(threshold) - F.lit(1e-9))
    size_class = F.floor(2 * F.log2("n") + F.lit(1e-9))
    largest = F.ceil(F.pow(F.lit(2.0), (F.col("size_class") + 1) / 2)) - 1
    largest = F.greatest(largest, F.col("n"))
    k = largest - F.ceil(largest * F.lit(threshold) - F.lit(1e-9)) + 1 + F.lit(slack)
    own = shingles.withColumn("size_class", size_class).withColumn("k", F.least(k, "n").cast("int"))
    own = own.groupBy("item_id", "n", "size_class", "k").agg(F.array_sort(F.collect_list("hash")).alias("hashes"))
    need = F.greatest(F.lit(1), F.col("k") - (F.col("n") - needed))
    return own.select("item_id", "size_class", need.cast("int").alias("need"), F.explode(F.slice("hashes", F.lit(1), F.col("k"))).alias("hash"))


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= MAX_BROADCAST_ROWS else df


def candidates(docs: DataFrame, sketch: DataFrame, lengths: list[int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, item_id) of the documents that meet enough of an item's sketch."""
    sketch = _small(sketch)
    rows = docs.select(F.col(id_col).alias("doc_id"), _hashes(F.col(text_col)).alias("h")).filter("doc_id is not null")
    hits = None
    for length in lengths:
        found = rows.select("doc_id", "h", F.explode(_starts(F.size("h"), length)).alias("at")).select(
            "doc_id", shingle_hash("h", length).alias("hash")).join(sketch, "hash").select("doc_id", "item_id", "need", "hash")
        hits = found if hits is None else hits.union(found)
    return hits.groupBy("doc_id", "item_id", "need").agg(F.count_distinct("hash").alias("hits")).filter("hits >= need").select("doc_id", "item_id")


def contained(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              item_col: str = "item_id", item_text_col: str = "text", shingle: int = SHINGLE,
              threshold: float = THRESHOLD, slack: int = SLACK) -> DataFrame:
    """(doc_id, item_id, item_shingles, found, containment) of every item contained in a document.

    Rows of one doc_id count as one document, rows of one item_id as one item;
    rows with a null id or null text give nothing, as does an empty table.
    Other columns are not read.
    """
    spark = docs.sparkSession
    index = written(item_shingles(items, item_col, item_text_col, shingle), "bench-shingles")
    lengths = [r[0] for r in index.select("length").distinct().collect()]  # 1 to ``shingle`` at most
    if not lengths:
        kind = dict(items.dtypes)[item_col]
        return spark.createDataFrame([], f"doc_id {dict(docs.dtypes)[id_col]}, item_id {kind}, item_shingles long, found long, containment double")
    found = candidates(docs, written(sketches(index, threshold, slack), "bench-sketch"), lengths, id_col, text_col)
    listed = written(found.groupBy("doc_id").agg(F.collect_set("item_id").alias("items")), "bench-candidates")  # no more than there are items
    known = _small(index.select("item_id", "shingle", "n"))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(listed, "doc_id")
    rows = rows.select("doc_id", "items", words(F.col("text")).alias("w"))
    hits = None
    for length in lengths:
        seen = rows.select("doc_id", "items", "w", F.explode(_starts(F.size("w"), length)).alias("at")).select(
            "doc_id", "items", F.concat_ws(" ", *_at("w", length)).alias("shingle"))
        seen = seen.join(known, "shingle").filter("array_contains(items, item_id)").select("doc_id", "item_id", "n", "shingle")
        hits = seen if hits is None else hits.union(seen)
    exact = hits.groupBy("doc_id", "item_id", "n").agg(F.count_distinct("shingle").alias("found"))
    return exact.filter(F.col("found") >= F.col("n") * F.lit(threshold) - F.lit(1e-9)).select(
        "doc_id", "item_id", F.col("n").alias("item_shingles"), "found", (F.col("found") / F.col("n")).alias("containment"))


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` (all columns) that contain no item; rows with a null id stay."""
    hit = written(contained(docs, items, id_col, text_col, **options).select(F.col("doc_id").alias("__hit")).distinct(), "bench-hits")
    return docs.join(hit, F.col(id_col) == F.col("__hit"), "left_anti")
