"""Session construction and cluster-safe defaults."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from multiprocessing.pool import ThreadPool
from pathlib import Path
from typing import Any

import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on: UTC wall clock (date parts and day counts are
# defined in UTC), adaptive execution for runtime re-planning and skew joins.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "truant",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the project defaults.

    ``master`` and ``shuffle_partitions`` are only meant for local runs; on a
    cluster they come from the submit configuration.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in BASE_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def sized_conf(input_bytes: int, partition_bytes: int = 256 << 20, min_partitions: int = 200) -> dict:
    """Shuffle and scan sizing for a given input volume.

    Scan splits and shuffle partitions target ``partition_bytes`` each so a
    task's working set fits executor memory; AQE starts from that many
    partitions, coalesces small ones and splits skewed ones (a key holding a
    large share of the rows is cut into several tasks instead of one).
    """
    n = max(min_partitions, -(-int(input_bytes) // partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    }


def plan_bytes(df: DataFrame) -> int:
    """Bytes that Spark estimates ``df`` to read."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def is_local(spark: SparkSession) -> bool:
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder and register it with the context.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local master,
    where driver and executors are one process, may go without: then a private
    temporary folder is created.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or \
        spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not is_local(spark):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="truant-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{checkpoint_dir(spark)}/truant/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "frame") -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet in the shared folder and read it
    back.  Later plans read only the columns they need, and a lost executor
    re-reads the files."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, rows: int, rows_per_task: int = 500_000, least: int = 5_000) -> DataFrame:
    """``df``, of about ``rows`` rows, dealt evenly to tasks: a multiple of the cores, each of ``rows_per_task``
    rows at most, or fewer tasks of ``least`` rows.

    For rows that are passed over hundreds of times.  The tasks of a scan follow
    from file sizes, so a small table would keep two cores busy, and any number
    of tasks that the cores do not divide leaves some idle at the end of a pass.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    waves = max(1, -(-rows // (cores * rows_per_task)))
    return df.repartition(max(1, min(cores * waves, -(-rows // least))))


def local_frame(spark: SparkSession, rows: list, **types: pa.DataType) -> DataFrame:
    """A frame of a few rows that the driver holds, handed over as one Arrow table (no task, no Python worker)."""
    columns = zip(*rows, strict=True) if rows else [()] * len(types)
    return spark.createDataFrame(pa.table({n: pa.array(c, t) for (n, t), c in zip(types.items(), columns, strict=True)}))


def side_by_side(spark: SparkSession, *steps: Callable[[], Any]) -> list:
    """The results of ``steps``, run at the same time: many short passes each, which leave cores idle between them."""
    with ThreadPool(len(steps)) as pool:
        return pool.map(inheritable_thread_target(spark)(lambda step: step()), steps, 1)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the workers, unless they find it in PYTHONPATH."""
    package = Path(__file__).resolve().parent
    app = spark.sparkContext.applicationId
    if app in _SHIPPED or str(package.parent) in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    archive = Path(tempfile.mkdtemp(prefix="truant-package-")) / "truant.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in package.rglob("*.py"):
            z.write(f, f.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))  # served by the driver
    _SHIPPED.add(app)
