"""Top-N per window on streams.

An append-mode windowed aggregate gives out all groups of a window in one micro-batch: the one
whose watermark passes the window's end. That batch therefore holds everything a window's
ranking needs, and the batch ranking runs on it as it is: no second state, no list of a window's
items in one task, ``WindowGroupLimit`` before the shuffle, any N.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from tidemark.streaming.sinks import BatchWrite, to_each_batch


def ranked(
    windowed: DataFrame, name: str, rank: Callable[[DataFrame], DataFrame], write: BatchWrite
) -> DataStreamWriter:
    """Rank each batch of ``windowed`` (an append-mode windowed aggregate) and write the result."""
    def each(batch: DataFrame, batch_id: int) -> None:
        write(rank(batch), batch_id)

    return to_each_batch(windowed, name, each)
