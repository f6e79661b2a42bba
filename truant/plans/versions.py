"""Commit protocol for what a run saves in several parts (feature state, model).

Every run writes its parts aside, ``<root>/<part>/<version>``, then lists all
files with their lengths and SHA-256, and writes that list last, to
``<root>/manifests/<version>``.  A version exists once its list does, and is
loaded only if every listed file is there unchanged.  So a run that breaks off
between two parts, or a file lost later, leaves the version before it in use.
Nothing is ever overwritten.  All reads and writes go through Spark, whatever
the store.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFESTS = "manifests"


def new_version() -> str:
    """An id that sorts by time."""
    return f"{time.time_ns():020d}-{uuid.uuid4().hex[:12]}"


def _missing(e: AnalysisException) -> bool:
    return e.getCondition() == "PATH_NOT_FOUND"


def files(spark: SparkSession, folder: str, part: str) -> DataFrame:
    """(part, path below the folder, length, sha256) of all files in ``folder``."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    tail = F.element_at(F.split("path", f"/{folder.rstrip('/').rpartition('/')[2]}/", 2), 2)
    return found.select(F.lit(part).alias("part"), tail.alias("path"), "length", F.sha2("content", 256).alias("sha256"))


def save(spark: SparkSession, root: str, parts: dict[str, Callable[[str], None]], version: str | None = None) -> str:
    """Write each part by its function of a path, then commit; returns the version."""
    version = version or new_version()
    for part, write in parts.items():
        write(f"{root}/{part}/{version}")
    listed = _listed(spark, root, version, parts)
    listed.select(F.to_json(F.struct("part", "path", "length", "sha256"))).coalesce(1).write.text(f"{root}/{MANIFESTS}/{version}")
    return version


def _listed(spark: SparkSession, root: str, version: str, parts: Iterable[str]) -> DataFrame:
    out = None
    for part in parts:
        own = files(spark, f"{root}/{part}/{version}", part)
        out = own if out is None else out.union(own)
    return out


def _manifest(spark: SparkSession, root: str, version: str) -> list[dict]:
    return [json.loads(r[0]) for r in spark.read.text(f"{root}/{MANIFESTS}/{version}").collect()]


def committed(spark: SparkSession, root: str) -> list[str]:
    """Versions with a manifest, newest first."""
    try:
        rows = spark.read.text(f"{root}/{MANIFESTS}/*").select(F.element_at(F.split("_metadata.file_path", "/"), -2).alias("version")).distinct().collect()
    except AnalysisException as e:
        if _missing(e):
            return []
        raise
    return sorted((r.version for r in rows), reverse=True)


def complete(spark: SparkSession, root: str, version: str) -> bool:
    """Whether every file of the version's manifest is there, unchanged."""
    want = {(f["part"], f["path"], f["length"], f["sha256"]) for f in _manifest(spark, root, version)}
    try:
        have = {tuple(r) for r in _listed(spark, root, version, sorted({w[0] for w in want})).collect()} if want else set()
    except AnalysisException as e:
        if _missing(e):
            return False
        raise
    return bool(want) and want <= have


def newest(spark: SparkSession, root: str) -> str | None:
    """The newest complete version; None if there is none."""
    return next((v for v in committed(spark, root) if complete(spark, root, v)), None)


def paths(spark: SparkSession, root: str, parts: Iterable[str], version: str | None = None) -> dict[str, str]:
    """Where to load the parts from: ``version``, else the newest complete one,
    else ``<root>/<part>`` itself if nothing was ever committed there."""
    if version is None:
        version = newest(spark, root)
        if version is None:
            if committed(spark, root):
                raise FileNotFoundError(f"no complete version in {root}")
            return {p: f"{root}/{p}" for p in parts}
    elif not complete(spark, root, version):
        raise FileNotFoundError(f"version {version} in {root} is not complete")
    return {p: f"{root}/{p}/{version}" for p in parts}
