"""Windowed aggregates: tumbling, sliding, session.

The batch forms pre-aggregate into panes: the first aggregation combines on the map side, so
a key holding a third of all rows leaves each task as at most one row per pane, and everything
after works on panes, not rows.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from tidemark.functions.durations import Duration, common_pane, interval, positive_micros, text
from tidemark.functions.eventtime import aligned, as_time, pane_of, time_type

# Aggregates whose partial results merge by adding up.
_ADDITIVE = {
    "count": lambda column: F.count(F.lit(1)),
    "sum": F.sum,
}


def _partials(measures: dict[str, tuple[str, str | None]]) -> list[Column]:
    return [_ADDITIVE[kind](column).alias(name) for name, (kind, column) in measures.items()]


def tumbling_agg(
    df: DataFrame,
    keys: list[str],
    ts: str,
    width: Duration,
    measures: dict[str, tuple[str, str | None]],
) -> DataFrame:
    """``keys, window_start, window_end, <measures>`` per tumbling window.

    ``measures`` maps an output name to ``("count", None)`` or ``("sum", column)``.
    """
    positive_micros(width)
    return (
        df.groupBy(*keys, F.window(ts, text(width)).alias("w"))
        .agg(*_partials(measures))
        .select(
            *keys,
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            *measures,
        )
    )


def tumbling_count(df: DataFrame, keys: list[str], ts: str, width: Duration, name: str = "n") -> DataFrame:
    return tumbling_agg(df, keys, ts, width, {name: ("count", None)})


def sliding_agg(
    df: DataFrame,
    keys: list[str],
    ts: str,
    size: Duration,
    slide: Duration,
    measures: dict[str, tuple[str, str | None]],
    panes: bool = True,
) -> DataFrame:
    """``keys, window_end, <measures>`` per sliding window.

    With ``panes`` a row is counted once, in a pane as wide as the greatest common divisor of
    size and slide; each pane is then added to the windows covering it. Without, each row is
    copied to every window first (``size / slide`` copies). Same result.
    """
    positive_micros(size), positive_micros(slide)
    if not panes:
        return (
            df.groupBy(*keys, F.window(ts, text(size), text(slide)).alias("w"))
            .agg(*_partials(measures))
            .select(*keys, F.col("w.end").alias("window_end"), *measures)
        )
    kind = time_type(df, ts)
    per_pane = (
        df.where(F.col(ts).isNotNull())
        .groupBy(*keys, pane_of(ts, common_pane(size, slide)).alias("pane"))
        .agg(*_partials(measures))
    )
    return panes_to_windows(per_pane, keys, "pane", size, slide, list(measures), kind)


def panes_to_windows(
    per_pane: DataFrame, keys: list[str], pane: str, size: Duration, slide: Duration,
    sums: list[str], kind: DataType,
) -> DataFrame:
    """Add up pane totals per sliding window: ``keys, window_end, <sums>``.

    ``pane`` is a start in microseconds; a pane lies in a window iff its start does, provided the pane
    width divides both size and slide. Panes are shuffled by key and block of time, once each (twice
    near a block's edge), and copied to their windows after that; a shuffle by key and window
    would move ``size / slide`` copies. The block keeps one key's panes from meeting in a single task.
    """
    size_us, slide_us = positive_micros(size), positive_micros(slide)
    if size_us < slide_us:
        raise ValueError("windows must not leave gaps: slide exceeds size")
    block_us = slide_us * 16 * -(-size_us // slide_us)
    block, start = timedelta(microseconds=block_us), F.col(pane)
    # The outer explode keeps Catalyst from inferring a filter on the sequence, which it would
    # push below the first aggregation and so evaluate for every row. No sequence here is empty.
    return (
        per_pane
        .withColumn("_first", aligned(start - size_us, slide) + slide_us)
        .withColumn("_last", aligned(start, slide))
        .withColumn("_block", F.explode_outer(F.sequence(
            aligned("_first", block), aligned("_last", block), F.lit(block_us))))
        .repartition(*keys, "_block")
        .withColumn("_start", F.explode_outer(F.sequence(
            F.greatest("_first", "_block"),
            F.least(F.col("_last"), F.col("_block") + (block_us - slide_us)),
            F.lit(slide_us),
        )))
        .groupBy(*keys, "_block", "_start")
        .agg(*(F.sum(name).alias(name) for name in sums))
        .select(*keys, as_time(F.col("_start") + size_us, kind).alias("window_end"), *sums)
    )


def sliding_count(
    df: DataFrame, keys: list[str], ts: str, size: Duration, slide: Duration,
    name: str = "view_count", panes: bool = True,
) -> DataFrame:
    return sliding_agg(df, keys, ts, size, slide, {name: ("count", None)}, panes)


def sliding_sum(
    df: DataFrame, keys: list[str], ts: str, size: Duration, slide: Duration,
    value: str, name: str = "allsum", panes: bool = True,
) -> DataFrame:
    return sliding_agg(df, keys, ts, size, slide, {name: ("sum", value)}, panes)


def session_panes(
    df: DataFrame, keys: list[str], ts: str, gap: Duration, measures: dict[str, tuple[str, str | None]]
) -> DataFrame:
    """``keys, pane, first_ts, last_ts, session_start, <measures>``: one row per non-empty pane
    as wide as the gap, with the start of the session it belongs to.

    Two rows in one such pane are less than a gap apart, so a pane never spans two sessions and
    the session boundaries follow from pane extremes alone. The ordered pass per key is thus over
    at most (time span / gap) rows, however many rows the key has. Rows exactly one gap apart
    share a session.
    """
    time_type(df, ts)
    per_pane = (
        df.where(F.col(ts).isNotNull())
        .groupBy(*keys, pane_of(ts, gap).alias("pane"))
        .agg(F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"), *_partials(measures))
    )
    in_order = Window.partitionBy(*keys).orderBy("pane")
    previous = F.lag("last_ts").over(in_order)
    opens = previous.isNull() | (F.col("first_ts") > previous + interval(gap))
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        per_pane.withColumn("opened_at", F.when(opens, F.col("first_ts")))
        .withColumn("session_start", F.last("opened_at", ignorenulls=True).over(so_far))
        .drop("opened_at")
    )


def session_agg(
    df: DataFrame, keys: list[str], ts: str, gap: Duration, measures: dict[str, tuple[str, str | None]]
) -> DataFrame:
    """``keys, session_start, session_end, <measures>``; the end is the last row's time plus the gap."""
    return (
        session_panes(df, keys, ts, gap, measures)
        .groupBy(*keys, "session_start")
        .agg((F.max("last_ts") + interval(gap)).alias("session_end"),
             *(F.sum(name).alias(name) for name in measures))
        .select(*keys, "session_start", "session_end", *measures)
    )


def session_count(df: DataFrame, keys: list[str], ts: str, gap: Duration, name: str = "n") -> DataFrame:
    return session_agg(df, keys, ts, gap, {name: ("count", None)})
