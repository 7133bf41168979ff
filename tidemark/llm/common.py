"""What the text operators share: table access, written intermediate tables, global positions."""

from __future__ import annotations

import ctypes
import shutil
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.session import checkpoint_root, shuffles_dropped


_shipped: set[str] = set()
# Rows of texts that a Python worker is handed at once; a worker holds a batch several times over.
BATCH_ROWS = 2000
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
# The same in bytes, for rows that hold whole blocks of texts.
BATCH_BYTES = 8 << 20
_BYTES_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship_code(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once per application: they import it by name, and the
    driver may have it on a path that they lack. Sees to it that they get rows in batches of bounded size."""
    bound_bytes(spark)
    if int(spark.conf.get(_BATCH_SETTING, "10000")) > BATCH_ROWS:
        spark.conf.set(_BATCH_SETTING, str(BATCH_ROWS))
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        root = Path(__file__).resolve().parents[2]
        archive = shutil.make_archive(
            f"{tempfile.mkdtemp(prefix='tidemark-code-')}/tidemark", "zip", root, "tidemark")
        context.addPyFile(archive)
        _shipped.add(context.applicationId)


def bound_bytes(spark: SparkSession) -> None:
    """Sees to it that the Python workers get long rows in batches of bounded bytes, a row or more at a time."""
    spark.conf.set(_BYTES_SETTING, str(BATCH_BYTES))


def release_memory() -> None:
    """Hands what this process has freed back to the system; the allocators would keep it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def releasing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same batches, the worker's memory given back after the last: an idle worker waits beside other
    tasks and holds what its largest batch took."""
    yield from batches
    release_memory()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """doc_id and text of docs; what other columns there are, and their names, doesn't matter."""
    ship_code(docs.sparkSession)
    return docs.select(
        docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"].cast("string").alias("text"))


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared checkpoint folder, read back: it cuts the lineage, is computed
    once, and outlives the executors that made it."""
    path = f"{checkpoint_root(df.sparkSession)}/tidemark-llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written_alone(df: DataFrame, name: str) -> DataFrame:
    """The same, and the shuffle files that it took go as soon as it is written."""
    with shuffles_dropped(df.sparkSession):
        return written(df, name)


def running_totals(
    df: DataFrame, order: Sequence[str], measures: dict[str, Column], part: str, name: str
) -> DataFrame:
    """Adds, for each measure, the sum over all rows before this one in the given order (``m``), and
    the sum over the whole table (``m_all``).

    Rows are dealt out by ranges of the order and written, so that a row's range is settled. Each
    range then sums up its own rows, and the ranges' totals, one row each, are summed in order: no
    task sees more than its range. ``order`` has to be unique, or tied rows interchangeable.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kept = df.columns
    ranged = written(
        df.withColumns(measures)
        .repartitionByRange(n, *order)
        .withColumn(part, F.spark_partition_id()),
        name,
    )
    totals = ranged.groupBy(part).agg(*(F.sum(m).alias(m) for m in measures))
    before = W.orderBy(part).rowsBetween(W.unboundedPreceding, -1)
    everything = W.orderBy(part).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    bases = totals.select(
        part,
        *(F.coalesce(F.sum(m).over(before), F.lit(0)).alias(f"{m}_base") for m in measures),
        *(F.sum(m).over(everything).alias(f"{m}_all") for m in measures),
    )
    inside = W.partitionBy(part).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    # One row per range of the sort: as many as there are shuffle partitions, whatever the data.
    return ranged.withColumns(
        {m: F.coalesce(F.sum(m).over(inside), F.lit(0)) for m in measures}
    ).join(F.broadcast(bases), part).select(
        *kept,
        *((F.col(m) + F.col(f"{m}_base")).alias(m) for m in measures),
        *(f"{m}_all" for m in measures),
    )
