"""Watermarks: how far the event clock trails the largest event time seen."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tidemark.functions.durations import Duration, text

# Slack of each feed.
RATE_DELAY = "1 second"
ASCENDING_DELAY = "0 seconds"
PERIODIC_DELAY = "3500 milliseconds"
EVENT_DELAY = "10 seconds"


def with_delay(df: DataFrame, ts: str, delay: Duration) -> DataFrame:
    """Out-of-order by at most ``delay``."""
    return df.withWatermark(ts, text(delay))


def ascending(df: DataFrame, ts: str) -> DataFrame:
    """In order: no slack."""
    return with_delay(df, ts, ASCENDING_DELAY)


def keeping_the_clock(predicate: Column) -> Column:
    """The predicate in a form Catalyst leaves above ``withWatermark``.

    A plain one is moved below it, and then the rows it rejects no longer advance the watermark.
    """
    return predicate.eqNullSafe(F.spark_partition_id() >= 0)


def plain_time(ts: str) -> Column:
    """The same instant as an ordinary column: no longer the stream's event time."""
    return F.timestamp_micros(F.unix_micros(ts))


def event_clock(query: StreamingQuery) -> list[tuple[int, str | None, str | None]]:
    """(batch, largest event time in it, watermark it ran with), for the query's recent batches."""
    return [
        (p.batchId, p.eventTime.get("max"), p.eventTime.get("watermark")) for p in query.recentProgress
    ]


class EventClockLog(StreamingQueryListener):
    """Logs the event clock of every batch; attach with ``spark.streams.addListener``."""

    def __init__(self, logger: logging.Logger | None = None):
        self._log = logger or logging.getLogger("tidemark.event_clock")

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        clock = event.progress.eventTime
        self._log.info(
            "batch %s: max event time %s, watermark %s",
            event.progress.batchId, clock.get("max"), clock.get("watermark"),
        )

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass
