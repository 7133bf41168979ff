"""Feed views over the ``events`` table.

Every view is a projection (plus one pushed-down filter on ``event_type``) of the whole
table; nothing is sampled or capped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.eventtime import epoch_millis, epoch_seconds
from tidemark.sources.schemas import CATEGORIES, CURRENCIES

# event_type -> behavior
BEHAVIOR_OF = {"view": "pv", "purchase": "buy", "click": "cart", "signup": "fav", "error": "other"}


EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table as a stream; ``ts`` is an instant, as watermarks ask for."""
    # As a pattern: a stream takes a folder or a pattern, while the table may be a single file.
    rows = spark.readStream.schema(EVENTS).parquet(f"{sf_dir}/{{events}}.parquet")
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def _pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (index + 1).cast("int"))


def _currency() -> Column:
    return _pick(CURRENCIES, F.col("user_id") % len(CURRENCIES))


def orders_feed(ev: DataFrame) -> DataFrame:
    return ev.where(F.col("event_type") == "purchase").select(
        "event_id",
        "ts",
        epoch_millis("ts").alias("ts_ms"),
        _pick(CATEGORIES, F.col("user_id") % len(CATEGORIES)).alias("category"),
        (_k() % 5).alias("subcat"),
        _currency().alias("currency"),
        F.round(F.col("value") * 100).cast("int").alias("amount"),
    )


def rate_feed(ev: DataFrame) -> DataFrame:
    return ev.where(F.col("event_type") == "click").select(
        "event_id",
        "ts",
        epoch_millis("ts").alias("ts_ms"),
        _currency().alias("currency"),
        (_k() % 20).alias("rate"),
    )


def behavior_feed(ev: DataFrame, *behaviors: str) -> DataFrame:
    """All rows, or those of the given behaviors (then filtered on the stored column, so the
    predicate reaches the Parquet scan)."""
    if behaviors:
        ev = ev.where(F.col("event_type").isin([t for t, b in BEHAVIOR_OF.items() if b in behaviors]))
    pairs = [x for t, b in BEHAVIOR_OF.items() for x in (F.lit(t), F.lit(b))]
    return ev.select(
        "event_id",
        "ts",
        "user_id",
        _k().cast("bigint").alias("item_id"),
        (_k() % 10).alias("category_id"),
        F.element_at(F.create_map(*pairs), F.col("event_type")).alias("behavior"),
        epoch_seconds("ts").alias("timestamp"),
    )
