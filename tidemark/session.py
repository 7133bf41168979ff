"""Session settings the library relies on.

Nothing here starts or stops a cluster: a session is handed in, and only runtime SQL
settings are touched.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Event time is an instant; windows and printed times are in UTC whatever the host says.
# Row joins rely on AQE to split a hot (key, window) partition by map output, which also
# splits a group made of copies of one row (hash salting cannot).
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A query over several streams goes by the slowest of their watermarks.
    "spark.sql.streaming.multipleWatermarkPolicy": "min",
    # A user's rows merge into sessions before they are shuffled, so a hot user leaves a task as few rows.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}

# For streams with large keyed state.
STATE_STORE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Else each store, of which a join has four per partition, takes 4 MB of disk ahead for its file list.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def configure_state_store(spark: SparkSession) -> SparkSession:
    """State on disk instead of the executors' heap."""
    for key, value in STATE_STORE_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def state_partitions(spark: SparkSession) -> Iterator[None]:
    """A new stream keeps for life the number of state partitions it starts with: the session's number of
    shuffle partitions, but no more than one per core, since each is a store of its own."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(int(before), spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What is written here, and streams started here, drop their shuffle files once they have run: else these stay on
    the executors' disks until the driver happens to collect its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints: the one the cluster names, else a local one.

    A local folder is only ever chosen on a local master; on a cluster the setting is
    required, because executors and a restarted driver must see the same files.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    root = tempfile.mkdtemp(prefix="tidemark-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def checkpoint_location(spark: SparkSession, query_name: str) -> str:
    return f"{checkpoint_root(spark)}/{query_name}"
