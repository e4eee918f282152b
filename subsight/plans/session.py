"""Session settings the plans rely on.

``configure`` sets only what the queries need for *correct* results: the
session time zone, since month text is formatted in it. Cluster-wide
settings (checkpoint folder, shuffle partitions, broadcast thresholds, AQE)
belong to whoever runs the cluster and are left alone; ``local_session``
sets them for tests and the benchmark.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings of the local sessions (tests, benchmark).
LOCAL_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # size-checked broadcast: the planner broadcasts a side only when its
    # estimated (or, under AQE, measured) size is below these thresholds;
    # above them the join is a shuffled sort-merge join.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
}


def cluster_settings(input_bytes: int, total_cores: int, shuffled_bytes: int | None = None,
                     target_partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Recommended settings for a cluster run over ``input_bytes`` of
    (compressed) input on ``total_cores`` task slots.

    * scans: splits of ``target_partition_bytes`` (``maxPartitionBytes``),
      so one task holds one split in memory;
    * shuffles: sized from what is shuffled, not from what is read. The
      plans prune columns and aggregate before they shuffle, so
      ``shuffled_bytes`` defaults to a tenth of the input; each reduce task
      gets about one split of it, with at least two waves of tasks, and AQE
      coalesces what is smaller and splits what is skewed;
    * skew: a partition 5x the median and over two splits is split;
    * broadcast: only sides under 64 MB (size-checked by the planner).

    At 100 TiB on 1,000 executors x 8 cores: 409,600 scan tasks and 40,960
    reducers of about 256 MB.
    """
    shuffled = input_bytes // 10 if shuffled_bytes is None else shuffled_bytes
    partitions = max(2 * total_cores, -(-shuffled // target_partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * target_partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    }


def configure(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names (``spark.checkpoint.dir``).

    A local temporary folder is set only for a local master with no folder
    configured (tests, local runs); on a cluster a missing setting is an
    error, since a machine-local folder does not survive a lost executor.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or \
        spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        spark.sparkContext.setCheckpointDir(conf_dir)
        return spark.sparkContext.getCheckpointDir() or conf_dir
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder")
    local = tempfile.mkdtemp(prefix="subsight-ckpt-")
    spark.sparkContext.setCheckpointDir(local)
    return spark.sparkContext.getCheckpointDir() or local


def checkpoint_base(spark: SparkSession) -> str:
    """The checkpoint folder as configured, the same in every driver.

    Spark appends a fresh random folder to it in each driver
    (:func:`checkpoint_dir`); what must be found again by the next driver, a
    stream's checkpoint, belongs directly below the configured folder.
    """
    return checkpoint_dir(spark).rstrip("/").rpartition("/")[0]


def local_session(cores: int | str = "*", app: str = "subsight", warehouse: str | None = None,
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("SUBSIGHT_DRIVER_MEMORY", "8g"))
    )
    for k, v in LOCAL_SETTINGS.items():
        builder = builder.config(k, v)
    if warehouse:
        builder = builder.config("spark.sql.warehouse.dir", warehouse)
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
