"""Orders converted by the rates of the same currency and window, and their sales ranking."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.durations import Duration, common_pane
from tidemark.functions.eventtime import aligned, pane_of, time_type
from tidemark.functions.report import SALES_LABEL, ranking_report
from tidemark.operators.joins import tumbling_window_join
from tidemark.operators.topn import top_n
from tidemark.operators.windows import panes_to_windows, sliding_sum

# Window sizes and N of the ranking.
JOIN_WINDOW = "10 seconds"
SALES_SIZE = "30 seconds"
SALES_SLIDE = "10 seconds"
SALES_TOP = 5

CONVERTED = [
    "ts_ms", "category", "subcat", "currency", "amount", "rate_ts_ms", "rate_currency", "rate", "res",
]


def item_id():
    return F.concat(F.col("category"), F.col("subcat").cast("string")).alias("item_id")


def converted_orders(
    orders: DataFrame, rates: DataFrame, width: Duration = JOIN_WINDOW, ts: str = "ts"
) -> DataFrame:
    """One row per (order, rate) pair: ``ts``, the order's fields, the rate's, and their product."""
    lhs = orders.select(ts, "ts_ms", "category", "subcat", "currency", "amount")
    rhs = rates.select(
        ts, F.col("ts_ms").alias("rate_ts_ms"), "currency", F.col("currency").alias("rate_currency"), "rate"
    )
    res = F.col("rate").cast("bigint") * F.col("amount")
    return tumbling_window_join(lhs, rhs, "currency", ts, width).withColumn("res", res).select(ts, *CONVERTED)


def sales_sums_by_pairs(
    orders: DataFrame, rates: DataFrame, width: Duration = JOIN_WINDOW,
    size: Duration = SALES_SIZE, slide: Duration = SALES_SLIDE, ts: str = "ts",
) -> DataFrame:
    """The sums below, by making every pair: the plain composition, to check the other against."""
    return sliding_sum(
        converted_orders(orders, rates, width, ts), ["category", "subcat"], ts, size, slide, "res"
    ).select(item_id(), "window_end", "allsum")


def sales_sums(
    orders: DataFrame, rates: DataFrame, width: Duration = JOIN_WINDOW,
    size: Duration = SALES_SIZE, slide: Duration = SALES_SLIDE, ts: str = "ts",
) -> DataFrame:
    """``item_id, window_end, allsum``: converted sales per category and subcategory.

    The sum of amount * rate over all pairs of a currency's window is the sum of its amounts times
    the sum of its rates. So both sides are aggregated before they meet, and the join is one
    row to one: no pair is formed, and hot currencies or windows shrink on the map side. Panes are
    narrow enough to lie in one join window and in one slide.
    """
    pane = common_pane(width, size, slide)
    amounts = (
        orders.where(F.col("currency").isNotNull() & F.col(ts).isNotNull())
        .groupBy("currency", "category", "subcat", pane_of(ts, pane).alias("pane"))
        .agg(F.sum("amount").alias("amounts"))
        .withColumn("join_window", aligned("pane", width))
    )
    rate_sums = (
        rates.where(F.col("currency").isNotNull() & F.col(ts).isNotNull())
        .groupBy("currency", pane_of(ts, width).alias("join_window"))
        .agg(F.sum("rate").alias("rates"))
    )
    per_pane = amounts.join(rate_sums, ["currency", "join_window"], "inner").select(
        "category", "subcat", "pane", (F.col("amounts") * F.col("rates")).alias("allsum")
    )
    kind = time_type(orders, ts)
    return panes_to_windows(
        per_pane, ["category", "subcat"], "pane", size, slide, ["allsum"], kind
    ).select(item_id(), "window_end", "allsum")


def rank_sales(sums: DataFrame, n: int = SALES_TOP, ascending: bool = False) -> DataFrame:
    return top_n(sums, ["window_end"], "allsum", n, ["item_id"], ascending)


def sales_ranking(
    orders: DataFrame, rates: DataFrame, width: Duration = JOIN_WINDOW,
    size: Duration = SALES_SIZE, slide: Duration = SALES_SLIDE,
    n: int = SALES_TOP, ascending: bool = False, ts: str = "ts",
) -> DataFrame:
    """``item_id, window_end, allsum, rk``: best-selling items per window, or (``ascending``) least."""
    return rank_sales(sales_sums(orders, rates, width, size, slide, ts), n, ascending)


def sales_report(ranked: DataFrame) -> DataFrame:
    return ranking_report(ranked, "item_id", "allsum", SALES_LABEL, rank_base=1)
