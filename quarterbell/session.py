"""Session settings the jobs are written for, and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Streams with many keys keep their state off the heap and upload only changes.
STREAM_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # of several groups of sources the slowest decides what is late
    "spark.sql.streaming.multipleWatermarkPolicy": "min",
}

# The adaptive planner merges and splits shuffle partitions by size. Larger splits and
# partitions keep the number of shuffle blocks (tasks times partitions) in bounds.
BATCH_SETTINGS = {
    "spark.sql.files.maxPartitionBytes": "512MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256MB",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def configure(spark: SparkSession, shuffle_partitions: int | None = None) -> SparkSession:
    """Apply the settings to a session.

    A stream keeps the number of shuffle partitions of its first start for
    ever, so set it before that to a small multiple of the cores of the
    cluster. A batch sets it to the reduced data divided by about 256 MB: 100 TB
    of messages leave some 10 TB of partial windows, that is 40,000; the
    adaptive planner merges what turns out too small.
    """
    for key, value in {**BATCH_SETTINGS, **STREAM_SETTINGS}.items():
        spark.conf.set(key, value)
    if shuffle_partitions is not None:
        spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    Only a local master may go without; it gets a folder of its own machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="quarterbell-"))
    return spark.sparkContext.getCheckpointDir()


def new_folder(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
