"""Session settings and the shared working folder."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # Joins and aggregates re-plan at run time; a hot key's partition is split even when that costs a shuffle.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
}


def build_session(app: str = "martpulse", master: str | None = None, **conf: str) -> SparkSession:
    """A session with this library's settings; the launcher chooses the master unless one is named."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@functools.cache
def _local_base() -> str:
    return tempfile.mkdtemp(prefix="martpulse-")


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder path below the cluster's shared checkpoint folder.

    ``spark.checkpoint.dir`` names the folder. Only a local master may do without it: there a temporary folder
    is the shared folder, as driver and tasks are one process.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = _local_base()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stream_session(spark: SparkSession, partitions: int | None = None) -> SparkSession:
    """A sibling session for streaming jobs, leaving the caller's settings alone.

    State is kept in RocksDB, so it may outgrow the executor heap, and is spread over one partition per core:
    the number is fixed for the life of a checkpoint, so it follows the cluster, not the batch.
    """
    sibling = spark.newSession()
    conf = sibling.conf
    conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    conf.set("spark.sql.shuffle.partitions", str(partitions or spark.sparkContext.defaultParallelism))
    conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    # One store per partition for both sides of a stream join instead of four.
    conf.set("spark.sql.streaming.join.stateFormatVersion", "3")
    return sibling
