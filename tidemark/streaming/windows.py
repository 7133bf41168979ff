"""Windowed aggregates on streams, in append mode: a window comes out once, when the watermark
passes its end; rows for it are dropped from then on.

State holds one accumulator per key and open window, never the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.durations import Duration, text
from tidemark.streaming.watermarks import keeping_the_clock


def window_agg(
    df: DataFrame, keys: list[str], ts: str | Column, size: Duration, slide: Duration, *measures: Column
) -> DataFrame:
    """``w, keys, <measures>``; ``w`` is the window struct and the stream's event time."""
    return df.groupBy(F.window(ts, text(size), text(slide)).alias("w"), *keys).agg(*measures)


def window_end(df: DataFrame) -> DataFrame:
    """Replace ``w`` by ``window_end``, as in the batch results."""
    return df.select(*(c for c in df.columns if c != "w"), F.col("w.end").alias("window_end"))


def session_counts(left: DataFrame, right: DataFrame, key: str, ts: str, gap: Duration) -> DataFrame:
    """``key, session_start, session_end, n_left, n_right`` of closed sessions with rows on both
    sides, sessions being merged over the rows of both.

    Both inputs carry a watermark on ``ts``. A session's left x right pairs that carry nothing but
    the key are stated in full by the two counts, so no row is kept in state.
    """
    both = left.select(key, ts, F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(
        right.select(key, ts, F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    return (
        both.where(keeping_the_clock(F.col(key).isNotNull()))
        .groupBy(F.session_window(ts, text(gap)).alias("s"), key)
        .agg(F.sum("l").alias("n_left"), F.sum("r").alias("n_right"))
        .where("n_left > 0 and n_right > 0")
        .select(key, F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"),
                "n_left", "n_right")
    )


def self_session_counts(df: DataFrame, key: str, ts: str, gap: Duration) -> DataFrame:
    """The same for a stream joined with itself: ``df`` is read once and is both sides, under one
    watermark. Each session's rows meet each other, so both counts are its size."""
    return (
        df.where(keeping_the_clock(F.col(key).isNotNull()))
        .groupBy(F.session_window(ts, text(gap)).alias("s"), key)
        .agg(F.count(F.lit(1)).alias("n_left"))
        .select(key, F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"),
                "n_left", F.col("n_left").alias("n_right"))
    )
