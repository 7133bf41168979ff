"""Most viewed items per sliding window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.durations import Duration
from tidemark.functions.report import VIEWS_LABEL, ranking_report
from tidemark.operators.topn import top_n
from tidemark.operators.windows import sliding_count

# Window sizes and N of the ranking.
VIEWS_SIZE = "60 minutes"
VIEWS_SLIDE = "5 minutes"
VIEWS_TOP = 3


def is_page_view() -> Column:
    return F.col("behavior") == "pv"


def page_views(behavior: DataFrame) -> DataFrame:
    return behavior.where(is_page_view())


def item_views(
    behavior: DataFrame, size: Duration = VIEWS_SIZE, slide: Duration = VIEWS_SLIDE,
    ts: str = "ts", panes: bool = True,
) -> DataFrame:
    """``item_id, window_end, view_count``."""
    return sliding_count(page_views(behavior), ["item_id"], ts, size, slide, panes=panes)


def rank_items(views: DataFrame, n: int = VIEWS_TOP) -> DataFrame:
    return top_n(views, ["window_end"], "view_count", n, ["item_id"])


def hot_items(
    behavior: DataFrame, size: Duration = VIEWS_SIZE, slide: Duration = VIEWS_SLIDE,
    n: int = VIEWS_TOP, ts: str = "ts", panes: bool = True,
) -> DataFrame:
    """``item_id, window_end, view_count, rk``."""
    return rank_items(item_views(behavior, size, slide, ts, panes), n)


def hot_items_report(ranked: DataFrame) -> DataFrame:
    """Numbered from 0, as this report always was; see ``sales_report`` for the one from 1."""
    return ranking_report(ranked, "item_id", "view_count", VIEWS_LABEL, rank_base=0)
