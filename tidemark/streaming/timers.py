"""Top-N per window by keyed state and event-time timers.

The form for a ranking that must come out at a window's own end, and not with whatever micro-batch
closes it, or that goes on to do more per window than rank: each window is a key with a list in the state
store and a timer. The list is cut to the N rows that can still be in the result, so it is
bounded however many items a window has. Rows go through Python one by one; for a plain ranking
``ranking.ranked`` does without a second state.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.functions.eventtime import epoch_millis


class WindowTopN(StatefulProcessor):
    """Rows of (item, measure) keyed by their window's end in epoch milliseconds."""

    def __init__(self, item: str, measure: str, kept: T.StructType, out: list[str], n: int, ascending: bool):
        self._item, self._measure, self._kept, self._out, self._n = item, measure, kept, out, n
        self._sign = 1 if ascending else -1

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._best = handle.getListState("best", self._kept)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held = [(r[0], r[1]) for r in self._best.get()] if self._best.exists() else []
        held += [(r[self._item], r[self._measure]) for r in rows]
        self._best.put(sorted(held, key=lambda r: (self._sign * r[1], r[0]))[:self._n])
        # Registering a timer again changes nothing.
        self._handle.registerTimer(key[0] + 1)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        best = [(r[0], r[1]) for r in self._best.get()]
        self._best.clear()
        for rank, (item, measure) in enumerate(best, 1):
            yield Row(**dict(zip(self._out, (key[0], item, measure, rank), strict=True)))

    def close(self) -> None:
        pass


def top_n_by_timer(
    windowed: DataFrame, item: str, measure: str, n: int, ascending: bool = False, rank: str = "rk"
) -> DataFrame:
    """``item, window_end, measure, rk`` of each window, once the event clock has passed its end.

    ``windowed`` is an append-mode windowed aggregate with the window struct ``w``, one row per window and
    item. Equal measures rank by item. Needs the state store of ``configure_state_store``.
    """
    fields = {f.name: f for f in windowed.schema.fields}
    kept = T.StructType([fields[item], fields[measure]])
    out = T.StructType([
        T.StructField("end_ms", T.LongType()), *kept.fields, T.StructField(rank, T.IntegerType())])
    return (
        windowed.withColumn("end_ms", epoch_millis("w.end")).groupBy("end_ms")
        .transformWithState(WindowTopN(item, measure, kept, out.names, n, ascending), out, "append", "eventTime")
        .select(item, F.timestamp_millis("end_ms").alias("window_end"), measure, rank)
    )
