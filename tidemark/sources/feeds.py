"""Readers. Each gives a DataFrame with one string column ``value`` (text feeds) or the
declared columns (CSV), as a table or as a stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.schemas import BEHAVIOR


def kafka_lines(
    spark: SparkSession,
    topic: str,
    servers: str = "localhost:9092",
    starting_offsets: str = "earliest",
    streaming: bool = True,
    **options: str,
) -> DataFrame:
    """A topic's values as text. Needs Spark's Kafka connector on the class path.

    Offsets live in the query's checkpoint, so no consumer group is set. Pass
    ``maxOffsetsPerTrigger`` / ``minPartitions`` as options to bound and spread a batch.
    """
    reader = spark.readStream if streaming else spark.read
    raw = (
        reader.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .options(**options)
        .load()
    )
    return raw.select(F.col("value").cast("string").alias("value"))


def text_lines(
    spark: SparkSession, path: str, streaming: bool = True, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Files of lines: the same ``value`` column a topic gives."""
    if not streaming:
        return spark.read.text(path)
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.text(path)


def csv_records(
    spark: SparkSession,
    path: str,
    schema: T.StructType = BEHAVIOR,
    streaming: bool = False,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Headerless CSV in declared field order; a malformed line fails the query, whatever is selected
    or counted: lines are parsed whole, and the check is a filter that pruning can't take away."""
    corrupt = "_corrupt"
    parsed = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
    rec = F.from_csv("value", parsed.simpleString()[len("struct<"):-1].replace(":", " "),
                     {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt})
    complaint = F.concat(F.lit("malformed line, not a record of ("), F.lit(", ".join(schema.names)),
                         F.lit("): "), "value")
    return (
        text_lines(spark, path, streaming, max_files_per_trigger)
        .where("trim(value) <> ''")
        # A generator of one row: the line is parsed once, however many of its fields are used.
        .select("value", F.explode_outer(F.array(rec)).alias("rec"))
        .where(F.when(F.col(f"rec.{corrupt}").isNull(), True).otherwise(
            F.raise_error(complaint).cast("boolean")))
        .select(*(F.col(f"rec.{name}").alias(name) for name in schema.names))
    )


def csv_twice(spark: SparkSession, path: str, streaming: bool = False, **kwargs) -> tuple[DataFrame, DataFrame]:
    """One file as two independent inputs of a self-join."""
    left = csv_records(spark, path, streaming=streaming, **kwargs)
    right = csv_records(spark, path, streaming=streaming, **kwargs) if streaming else left
    return left.alias("left"), right.alias("right")
