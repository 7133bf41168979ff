"""Durations: ``"10 seconds"``, ``"1 hour"`` or ``timedelta``, exact to the microsecond."""

from __future__ import annotations

import math
import re
from datetime import timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

Duration = str | timedelta

_UNIT_MICROS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 604_800_000_000,
}


def micros(duration: Duration) -> int:
    if isinstance(duration, timedelta):
        return duration // timedelta(microseconds=1)
    parts = re.findall(r"(\d+)\s+([a-z]+?)s?(?=\s|$)", duration.strip().lower())
    rebuilt = " ".join(f"{n} {u}" for n, u in parts)
    if not parts or rebuilt != re.sub(r"s(?=\s|$)", "", " ".join(duration.lower().split())):
        raise ValueError(f"not a duration: {duration!r}")
    unknown = [unit for _, unit in parts if unit not in _UNIT_MICROS]
    if unknown:
        raise ValueError(f"no fixed length for unit {unknown[0]!r} in {duration!r}")
    return sum(int(n) * _UNIT_MICROS[unit] for n, unit in parts)


def positive_micros(duration: Duration) -> int:
    us = micros(duration)
    if us <= 0:
        raise ValueError(f"duration must be positive: {duration!r}")
    return us


def text(duration: Duration) -> str:
    """The form ``F.window`` and ``withWatermark`` take."""
    return duration if isinstance(duration, str) else f"{micros(duration)} microseconds"


def interval(duration: Duration) -> Column:
    return F.lit(timedelta(microseconds=micros(duration)))


def common_pane(*durations: Duration) -> str:
    """Widest tumbling width every given duration is a multiple of."""
    return f"{math.gcd(*(positive_micros(d) for d in durations))} microseconds"
