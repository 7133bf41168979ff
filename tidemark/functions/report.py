"""Ranking reports as text, one string per window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The printed form of a report.
RULE = "===================================="
TIME_LABEL = "时间: "
ITEM_LABEL = "商品ID="
VIEWS_LABEL = "浏览量="
SALES_LABEL = "销售额="


def printed_time(ts: Column) -> Column:
    """``2024-01-01 00:05:00.0``: at least one and at most three fraction digits."""
    return F.regexp_replace(F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSS"), "0{1,2}$", "")


def ranking_report(
    ranked: DataFrame, item: str, measure: str, measure_label: str,
    rank: str = "rk", rank_base: int = 1, window_end: str = "window_end", report: str = "report",
) -> DataFrame:
    """``window_end, report``. ``ranked`` holds the few top rows of each window, so the list
    gathered per window is bounded by N."""
    lines = F.transform(
        F.array_sort(F.collect_list(F.struct(F.col(rank), F.col(item), F.col(measure)))),
        lambda row: F.concat(
            F.lit("No"), (row[rank] - 1 + rank_base).cast("string"), F.lit(":"),
            F.lit("  " + ITEM_LABEL), row[item].cast("string"),
            F.lit("  " + measure_label), row[measure].cast("string"), F.lit("\n"),
        ),
    )
    return ranked.groupBy(window_end).agg(F.array_join(lines, "").alias("_lines")).select(
        window_end,
        F.concat(
            F.lit(RULE + "\n" + TIME_LABEL), printed_time(F.col(window_end)), F.lit("\n"),
            F.col("_lines"), F.lit(RULE + "\n\n"),
        ).alias(report),
    )
