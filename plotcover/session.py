"""Spark session defaults and the shared checkpoint folder.

The library never creates a session behind the caller's back; these helpers
are for scripts, tests and the bench.  On a cluster the checkpoint folder must
be the shared one the cluster names in ``spark.checkpoint.dir``; a private
temporary folder is only made when that setting is unset on a local master.
"""

from __future__ import annotations

import math
import tempfile

from pyspark.sql import SparkSession

# Settings every job of the engine relies on.  Shuffle width is left to the
# caller (cores locally, data size on a cluster); AQE coalesces small
# partitions and splits skewed join partitions.  No join is broadcast on a
# planner estimate (a compressed file size says little about rows in memory):
# dimension tables are broadcast after a bounded row count
# (bounds.broadcast_if_bounded), and AQE turns a shuffle join into a
# broadcast join only when the measured shuffle output is under 10 MB.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    master: str = "local[*]",
    app_name: str = "plotcover",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    # without a given width, a local session takes its cores; a cluster keeps
    # its own setting until apply_partition_conf sizes it from the input
    spark = builder.getOrCreate()
    if shuffle_partitions is None and spark.sparkContext.master.startswith("local["):
        spark.conf.set("spark.sql.shuffle.partitions", str(spark.sparkContext.defaultParallelism))
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


# Partition sizing for a cluster run.  A task should hold a few hundred MB of
# shuffle data at most, so that sorting it for a join stays in executor
# memory; the species join shuffles the projected vegetation columns, about a
# quarter of the stored bytes.
TARGET_SHUFFLE_PARTITION_BYTES = 200 * 1024 * 1024
SCAN_SPLIT_BYTES = 256 * 1024 * 1024
SHUFFLED_FRACTION = 0.25


def partition_conf(input_bytes: int, total_cores: int,
                   shuffled_fraction: float = SHUFFLED_FRACTION,
                   target_bytes: int = TARGET_SHUFFLE_PARTITION_BYTES,
                   split_bytes: int = SCAN_SPLIT_BYTES) -> dict[str, str]:
    """Shuffle width and scan split size for a job reading ``input_bytes``
    of Parquet on ``total_cores`` cores.

    The shuffle starts wide enough that a partition of the largest shuffle
    is about ``target_bytes`` (never fewer than two waves of tasks); AQE then
    merges small partitions up to that size rather than to the core count,
    and splits a skewed join partition.  Scan splits of ``split_bytes`` keep
    the number of map tasks, and so of shuffle blocks, in bounds."""
    shuffled = input_bytes * shuffled_fraction
    partitions = max(2 * total_cores, math.ceil(shuffled / target_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_bytes),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * target_bytes),
        "spark.sql.files.maxPartitionBytes": str(split_bytes),
    }


def stored_bytes(spark: SparkSession, *paths: str) -> int:
    """Bytes stored under the given paths (files or folders), read from the
    file system's metadata, not by scanning."""
    sc = spark.sparkContext
    conf = sc._jsc.hadoopConfiguration()
    total = 0
    for path in paths:
        hpath = sc._jvm.org.apache.hadoop.fs.Path(path)
        total += hpath.getFileSystem(conf).getContentSummary(hpath).getLength()
    return int(total)


def apply_partition_conf(spark: SparkSession, input_bytes: int) -> dict[str, str]:
    """Size a running session's partitions for ``input_bytes`` of input on
    the cores the session has (these are all runtime SQL settings)."""
    conf = partition_conf(input_bytes, spark.sparkContext.defaultParallelism)
    for key, value in conf.items():
        spark.conf.set(key, value)
    return conf


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a private one only when
    the session runs on a local master and none is configured."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; a cluster job needs the shared "
            "checkpoint folder to cut lineage"
        )
    path = tempfile.mkdtemp(prefix="plotcover-ckpt-")
    sc.setCheckpointDir(path)
    spark.conf.set("spark.checkpoint.dir", path)
    return path
