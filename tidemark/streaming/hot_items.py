"""Streaming form of the view counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.durations import Duration
from tidemark.plans.hot_items import VIEWS_SIZE, VIEWS_SLIDE, VIEWS_TOP, is_page_view
from tidemark.streaming.timers import top_n_by_timer
from tidemark.streaming.watermarks import ASCENDING_DELAY, keeping_the_clock, with_delay
from tidemark.streaming.windows import window_agg, window_end


def windowed_views(
    behavior: DataFrame, size: Duration = VIEWS_SIZE, slide: Duration = VIEWS_SLIDE,
    delay: Duration = ASCENDING_DELAY, ts: str = "ts",
) -> DataFrame:
    """``w, item_id, view_count``. The watermark follows all rows, the count only views.

    Rows are added to their windows one by one, not by pane: a late row still counts in those of
    its windows that are open.
    """
    views = with_delay(behavior, ts, delay).where(keeping_the_clock(is_page_view()))
    return window_agg(views, ["item_id"], ts, size, slide, F.count(F.lit(1)).alias("view_count"))


def item_views(behavior: DataFrame, *args, **kwargs) -> DataFrame:
    """``item_id, window_end, view_count``, of ``windowed_views``."""
    return window_end(windowed_views(behavior, *args, **kwargs))


def hot_items_by_timer(behavior: DataFrame, *args, n: int = VIEWS_TOP, **kwargs) -> DataFrame:
    """``item_id, window_end, view_count, rk``: the most viewed items by a timer per window."""
    return top_n_by_timer(windowed_views(behavior, *args, **kwargs), "item_id", "view_count", n)
