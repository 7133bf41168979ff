"""Sinks. Every query keeps its offsets and state under the session's shared checkpoint folder, so
it goes on where it stopped when the driver or executors are lost.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

from tidemark.session import checkpoint_location, state_partitions

# After any event time, and before the last time that a window could end.
END_OF_TIME = "9999-01-01 00:00:00+00:00"

# For Parquet files whose rows repeat whole lists of the rows before: as written out, copies are near each other
# and take next to nothing once compressed, while places in a dictionary would be cut at odd bits. Row groups
# are small, since a reader holds the lists of up to one.
REPEATED_LISTS = {
    "compression": "zstd", "parquet.enable.dictionary": "false", "parquet.block.size": str(16 << 20),
    "parquet.page.size.row.check.min": "10",
}

# Writes one micro-batch. It may be called again for the same id after a failure.
BatchWrite = Callable[[DataFrame, int], None]


def _writer(df: DataFrame, name: str) -> DataStreamWriter:
    return (
        df.writeStream.queryName(name)
        .outputMode("append")
        .option("checkpointLocation", checkpoint_location(df.sparkSession, name))
    )


def to_console(df: DataFrame, name: str, rows: int = 20) -> DataStreamWriter:
    return _writer(df, name).format("console").option("truncate", False).option("numRows", rows)


def to_files(df: DataFrame, name: str, path: str, fmt: str = "parquet") -> DataStreamWriter:
    """``fmt="text"`` takes a single ``value`` column."""
    return _writer(df, name).format(fmt).option("path", path)


def to_kafka(df: DataFrame, name: str, topic: str, servers: str = "localhost:9092") -> DataStreamWriter:
    """Writes ``value``. Needs Spark's Kafka connector on the class path."""
    return (
        _writer(df.select("value"), name).format("kafka")
        .option("kafka.bootstrap.servers", servers).option("topic", topic)
    )


def to_each_batch(df: DataFrame, name: str, write: BatchWrite) -> DataStreamWriter:
    return _writer(df, name).foreachBatch(write)


# Gives a stream with the end of its input added: see ``catch_up``.
UntilEnd = Callable[[DataFrame], DataFrame]


def catch_up(spark: SparkSession, name: str, start: Callable[[str, str, UntilEnd], DataStreamWriter]) -> DataFrame:
    """Run a query over everything its sources hold now, up to the end, and read back what it wrote.

    ``start(run, path, until_end)`` gives the query, named ``run`` and writing Parquet to ``path``; each call is
    a new run with a folder of its own under the shared checkpoint folder. ``until_end`` is to be put around
    each input before its watermark. It adds a second source, the clock, which holds nothing while the input is
    read. Then the query is started once more on its checkpoint, with one row in the clock that is
    null but for a time after all others: it closes every window and session that is still open, and its own
    window stays open for good. So the input counts as ended, as a bounded one has.
    """
    run = f"{name}-{uuid.uuid4().hex}"
    path, clock = (f"{checkpoint_location(spark, run)}-{kind}" for kind in ("result", "clock"))

    def tick(when: str) -> None:
        spark.sql(f"SELECT timestamp'{END_OF_TIME}' AS ts WHERE {when}").write.mode("append").parquet(clock)

    def until_end(df: DataFrame, ts: str = "ts") -> DataFrame:
        ticks = spark.readStream.schema("ts timestamp").parquet(clock)
        return df.unionByName(ticks.withColumnRenamed("ts", ts), allowMissingColumns=True)

    with state_partitions(spark):
        for ended in ("false", "true"):
            tick(ended)
            start(run, path, until_end).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(path)


# --- writes for to_each_batch ---------------------------------------------------------------


def batch_files(path: str, fmt: str = "parquet") -> BatchWrite:
    """One sub-folder per batch, replaced if the batch is written again."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").format(fmt).save(f"{path}/batch_id={batch_id}")
    return write


def batch_kafka(topic: str, servers: str = "localhost:9092") -> BatchWrite:
    """At least once: a batch written again sends its lines again."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.select("value").write.format("kafka").option(
            "kafka.bootstrap.servers", servers).option("topic", topic).save()
    return write


def batch_console(rows: int = 20) -> BatchWrite:
    def write(batch: DataFrame, batch_id: int) -> None:
        print(f"batch {batch_id}")
        batch.show(rows, truncate=False)
    return write


def fan_out(*writes: BatchWrite) -> BatchWrite:
    """The same batch to several sinks, computed once."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for each in writes:
                each(batch, batch_id)
        finally:
            batch.unpersist()
    return write
