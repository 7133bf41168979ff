"""Event-time columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, TimestampNTZType, TimestampType

from tidemark.functions.durations import Duration, positive_micros

ColumnOrName = Column | str

UTC_NAMES = ("UTC", "Etc/UTC", "GMT", "Z", "+00:00")


def _instant(ts: ColumnOrName) -> Column:
    return (F.col(ts) if isinstance(ts, str) else ts).cast("timestamp")


def from_epoch_millis(epoch_ms: ColumnOrName) -> Column:
    return F.timestamp_millis(epoch_ms)


def from_epoch_seconds(epoch_s: ColumnOrName) -> Column:
    return F.timestamp_seconds(epoch_s)


def epoch_millis(ts: ColumnOrName) -> Column:
    """Epoch milliseconds of a TIMESTAMP, or of a TIMESTAMP_NTZ holding UTC; floors."""
    return F.unix_millis(_instant(ts))


def epoch_seconds(ts: ColumnOrName) -> Column:
    return F.unix_seconds(_instant(ts))


def naive(ts: ColumnOrName) -> Column:
    """Zone-less UTC time, the type tables hold."""
    return (F.col(ts) if isinstance(ts, str) else ts).cast("timestamp_ntz")


def micros(ts: ColumnOrName) -> Column:
    """Epoch microseconds, the form panes are computed in: plain integer arithmetic, which stays cheap
    when one bound is derived from another."""
    return F.unix_micros(_instant(ts))


def aligned(us: ColumnOrName, width: Duration) -> Column:
    """Start, in microseconds, of the epoch-aligned pane holding ``us``; correct before 1970 too."""
    us = F.col(us) if isinstance(us, str) else us
    return us - F.pmod(us, F.lit(positive_micros(width)))


def pane_of(ts: ColumnOrName, width: Duration) -> Column:
    return aligned(micros(ts), width)


def as_time(us: Column, like: DataType) -> Column:
    """Back from microseconds, to the type of the event-time column."""
    return F.timestamp_micros(us).cast(like)


def time_type(df: DataFrame, ts: str) -> DataType:
    """Type of the event-time column. A zone-less one is read as UTC, so the session must be in UTC."""
    kind = df.schema[ts].dataType
    if not isinstance(kind, (TimestampType, TimestampNTZType)):
        raise TypeError(f"{ts} is {kind.simpleString()}, not a time")
    zone = df.sparkSession.conf.get("spark.sql.session.timeZone")
    if isinstance(kind, TimestampNTZType) and zone not in UTC_NAMES:
        raise ValueError(f"zone-less times need the session in UTC, not {zone}: see tidemark.session.configure")
    return kind
