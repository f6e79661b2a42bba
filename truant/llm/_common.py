"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A join key holding more than this share of the counted rows is hot; so at most 1/HOT_SHARE keys are.
HOT_SHARE = 1 / 1000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, named in ``spark.checkpoint.dir``.

    Only a local master may go without that setting: then a temporary folder
    is made and set, since driver and executors are one process.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        d = tempfile.mkdtemp(prefix="truant-shared-")
        spark.conf.set("spark.checkpoint.dir", d)
    return d.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/truant-llm/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, by: str | None = None, compression: str = "zstd") -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet in the shared folder, apart by the values of ``by``, and read it back."""
    path = new_folder(df.sparkSession, name)
    out = df.write.option("compression", compression)
    (out.partitionBy(by) if by else out).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def id_crc_mod(c: Column, m: int) -> Column:
    """crc32 of the id's decimal text, modulo ``m``; null for a null id."""
    return F.crc32(c.cast("string").cast("binary")) % F.lit(m)


def keyed_join(rows: DataFrame, groups: DataFrame, on: list[str], count: str, total: int | None = None) -> DataFrame:
    """Inner join of many ``rows`` to ``groups``, which has one row per key and in ``count`` the key's rows.

    Keys with more than HOT_SHARE of the rows (so at most 1/HOT_SHARE of them)
    are joined by broadcast, where the rows stay in the tasks they are in; all
    others by a shuffle in which no key is large.  Both inputs are read twice
    and should be written tables.
    """
    total = groups.agg(F.sum(count)).first()[0] or 0 if total is None else total
    limit = max(1.0, total * HOT_SHARE)
    hot = F.broadcast(groups.filter(F.col(count) > limit))
    few = groups.filter(F.col(count) <= limit)
    return rows.join(hot, on).unionByName(rows.join(hot, on, "left_anti").join(few, on))
