"""Spark session settings shared by every job.

The settings are plain SQL confs, so they can be applied to a session somebody
else created.  Cluster-level choices (executors, memory, default shuffle width)
stay with whoever submits the application.
"""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import SparkSession

TARGET_PARTITION_BYTES = 64 * 1024 * 1024
SMALLEST_PARTITION_BYTES = 2 * 1024 * 1024

RUNTIME_CONF = {
    # timestamps are zone-less, so results must not depend on the machine
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # merge up to the advisory size, not just until every core has a task
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    # split a hot join key even when that costs one more shuffle afterwards
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def shuffle_partitions(input_bytes: int, cores: int) -> int:
    """Shuffle width that keeps one partition near the target size."""
    wanted = math.ceil(input_bytes / TARGET_PARTITION_BYTES)
    return max(cores, wanted)


def configure(spark: SparkSession, input_bytes: int | None = None) -> SparkSession:
    """Apply the runtime settings to a running session.

    With ``input_bytes`` the initial shuffle width follows the size of the input, and
    adaptive execution merges small partitions up to the target size; for an input that
    would not fill the cores at that size, up to an even share per core.
    """
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    if input_bytes is not None:
        cores = spark.sparkContext.defaultParallelism
        share = max(SMALLEST_PARTITION_BYTES, min(input_bytes // cores, TARGET_PARTITION_BYTES))
        width = shuffle_partitions(input_bytes, cores)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(width))
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(share))
    return spark


def widen(spark: SparkSession, input_bytes: int, spread: int = 4) -> SparkSession:
    """Raise the initial shuffle width, never lower it, to what an input of this size needs.

    ``spread`` is how many bytes a job shuffles for a byte of compressed input.
    """
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    width = int(spark.conf.get(key, None) or spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = math.ceil(input_bytes * spread / TARGET_PARTITION_BYTES)
    if wanted > width:
        spark.conf.set(key, str(wanted))
    return spark


def input_files(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(name, bytes, time) of the files below a path, wherever Spark can read them."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(root, True)
    found = []
    while files.hasNext():
        file = files.next()
        found.append((file.getPath().toString(), file.getLen(), file.getModificationTime()))
    return sorted(found)


def get_session(app_name: str = "tradewind", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or reuse) a session with the runtime settings applied."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def workspace(spark: SparkSession, purpose: str) -> str:
    """A new folder path for tables, models and stream checkpoints of one run.

    It lies in the shared folder named by ``spark.checkpoint.dir``.  Only a local
    session without that setting falls back to a temporary folder, because there
    all executors live in this one process.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="tradewind-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
