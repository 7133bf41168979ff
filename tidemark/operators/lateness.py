"""Lateness against a watermark that trails the largest event time seen so far."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.durations import Duration, micros, positive_micros
from tidemark.functions.eventtime import as_time, pane_of, time_type
from tidemark.functions.eventtime import micros as micros_of

# Windows of one source that are put in order together.
BLOCK = 4096


def mark_late(
    df: DataFrame, source: list[str], arrival: str, ties: list[str], ts: str,
    window: Duration, delay: Duration, late: str = "late", block: int = BLOCK,
) -> DataFrame:
    """Add ``window_end`` and the flag ``late``: the row's tumbling window had closed when it came,
    i.e. its end is at or before (largest ``ts`` among the source's earlier arrivals - ``delay``).

    ``arrival`` and then ``ties`` say which row came earlier; rows equal in all of them come at once. A null
    source is a source like any other, a row without ``ts`` closes no window and is not late.

    A window is closed by the first row whose time is at least its end plus the delay. So no row is put
    in order: each source's rows are summed up, on the map side, as the first arrival per window that
    they close, and minima are carried from later windows to earlier ones. What is ordered has
    one row per window of a source, however many rows the source has or come at once, and is cut in
    blocks of windows. Rows then meet the one row of their window, which leaves a hot source to be split
    by AQE. Nothing runs while this is called.
    """
    kind, width_us = time_type(df, ts), positive_micros(window)
    end = pane_of(ts, window) + width_us
    # The latest window that a row closes: the last end at or before its time less the delay.
    past = micros_of(ts) - micros(delay)
    closes = past - F.pmod(past, F.lit(width_us))
    keys = [F.col(c).alias(f"_s{i}") for i, c in enumerate(source)]
    names = [f"_s{i}" for i in range(len(source))]
    order = F.struct(F.col(arrival).alias("a"), *(F.col(c).alias(f"t{i}") for i, c in enumerate(ties)))
    # Each row's own window is listed too, so that it finds an equal end to join to.
    listed = df.where(F.col(ts).isNotNull()).select(*keys, F.explode(F.array(
        F.struct(closes.alias("end"), order.alias("first")),
        F.struct(end.alias("end"), F.when(F.lit(False), order).alias("first")))).alias("w")).select(*names, "w.*")
    per_window = listed.groupBy(*names, "end").agg(F.min("first").alias("first")).withColumn(
        "block", F.floor(F.col("end") / (width_us * block)))
    after = Window.unboundedPreceding, -1
    later_blocks = per_window.groupBy(*names, "block").agg(F.min("first").alias("in_block")).select(
        *names, "block", F.min("in_block").over(
            Window.partitionBy(*names).orderBy(F.desc("block")).rowsBetween(*after)).alias("beyond"))
    own = Window.partitionBy(*names, "block").orderBy(F.desc("end")).rowsBetween(Window.unboundedPreceding, 0)
    closed = (
        per_window.withColumn("within", F.min("first").over(own))
        .join(later_blocks.withColumnsRenamed({n: f"_b{n}" for n in names} | {"block": "_block"}),
              _same(names, [f"_b{n}" for n in names]) & (F.col("block") == F.col("_block")), "left")
        # Null where no row closes the window; least() passes over nulls.
        .select(*names, F.col("end").alias("_closed_end"), F.least("within", "beyond").alias("_closed_by"))
    )
    marked = df.withColumn("_end", end).join(closed, _same(source, names) & (F.col("_end") == F.col("_closed_end")), "left")
    return marked.select(
        *df.columns, as_time(F.col("_end"), kind).alias("window_end"),
        F.coalesce(F.col("_closed_by") < order, F.lit(False)).alias(late))


def _same(left: list[str], right: list[str]) -> Column:
    same = F.lit(True)
    for a, b in zip(left, right, strict=True):
        same = same & F.col(a).eqNullSafe(F.col(b))
    return same


def drop_late(df: DataFrame, **kwargs) -> DataFrame:
    """Only the rows whose window was still open when they came."""
    return mark_late(df, **kwargs).where(~F.col(kwargs.get("late", "late")))
