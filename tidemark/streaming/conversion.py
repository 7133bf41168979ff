"""Streaming form of the currency conversion and the sales sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.durations import Duration, positive_micros, text
from tidemark.plans.conversion import CONVERTED, JOIN_WINDOW, SALES_SIZE, SALES_SLIDE, item_id
from tidemark.streaming.watermarks import ASCENDING_DELAY, RATE_DELAY, keeping_the_clock, plain_time, with_delay
from tidemark.streaming.windows import window_agg, window_end


def converted_orders(
    orders: DataFrame, rates: DataFrame, width: Duration = JOIN_WINDOW,
    order_delay: Duration = ASCENDING_DELAY, rate_delay: Duration = RATE_DELAY, ts: str = "ts",
    cells: tuple[int, int] = (4, 4), lots: int = 16, paired: bool = True,
) -> DataFrame:
    """``w, ts`` and the converted fields, one row per (order, rate) pair of a currency's window.

    The window, not the row's own time, is the event time of the join. So a row is late only once
    its window has closed, and both sides' rows leave the state with their window. A currency may
    hold any share of the orders and of the rates: its window is a grid of ``cells`` (rows, columns). An order is
    in one row of it, a rate in one column, so each cell joins a part of the orders with a part of the rates. Where a
    row goes follows from its fields alone, whichever task it is read in and however often. Each side of a cell is
    gathered in ``lots`` lists, dealt the same way, and the lists meet once the window has closed: so state is read
    once per two lists and not once per pair, and pairs are made from lists in memory. What is only to be
    summed needs no pairs: see ``sales_sums``.

    If not ``paired``, a row is two lists that meet (``w, currency, orders, rates``), of which ``pairs_of`` makes the
    pairs, without ``ts``. Pairs grow with the square of a window's rows, so files of them do; files of lists don't. Then
    ``lots`` lists are all that a window's side has. They are gathered before they are dealt to cells, and only
    lists of rates are copied, to every row of cells: state holds an order once, and a rate once until its window closes.
    """
    down, across = cells
    lhs = (
        with_delay(orders, ts, order_delay).where(keeping_the_clock(F.col("currency").isNotNull()))
        .withColumn("w", F.window(ts, text(width)))
        .select("w", plain_time(ts).alias(ts), "ts_ms", "category", "subcat", "currency", "amount")
    )
    rhs = (
        with_delay(rates, ts, rate_delay).where(keeping_the_clock(F.col("currency").isNotNull()))
        .withColumn("w", F.window(ts, text(width)))
        .select("w", F.col("ts_ms").alias("rate_ts_ms"), "currency", "rate")
    )
    window = ["w", "currency"]

    def fields(side: DataFrame) -> list[str]:
        return [c for c in side.columns if c not in (*window, "cell_row", "cell_column")]

    def place(side: DataFrame, cells: int) -> Column:
        return F.pmod(F.xxhash64(*fields(side)), F.lit(cells)).cast("int")

    def every(cells: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(cells - 1)))

    def lists(side: DataFrame, name: str, keys: list[str]) -> DataFrame:
        lot = F.pmod(F.xxhash64(F.lit(name), *fields(side)), F.lit(lots)).cast("int").alias("lot")
        return side.groupBy(*keys, lot).agg(F.collect_list(F.struct(*fields(side))).alias(name))

    if paired:
        cell = [*window, "cell_row", "cell_column"]
        lhs = lhs.withColumn("cell_row", place(lhs, down)).withColumn("cell_column", every(across))
        rhs = rhs.withColumn("cell_column", place(rhs, across)).withColumn("cell_row", every(down))
        lhs, rhs = lists(lhs, "orders", cell), lists(rhs, "rates", cell)
    else:
        cell = [*window, "cell_row"]
        lhs = lists(lhs.drop(ts), "orders", window).withColumn("cell_row", F.col("lot") % down)
        rhs = lists(rhs, "rates", window).withColumn("cell_row", every(down))
    met = lhs.drop("lot").join(rhs.drop("lot"), cell, "inner").select(*window, "orders", "rates")
    return pairs_of(met, ts) if paired else met


def pairs_of(lists: DataFrame, *more: str) -> DataFrame:
    """The converted fields, and ``more`` of the orders', of every pair of an order and a rate in lists of one row
    (``converted_orders(..., paired=False)``), with ``w`` if it is there."""
    kept = [c for c in lists.columns if c == "w"]
    return (
        lists.withColumn("order", F.explode("orders")).withColumn("rated", F.explode("rates"))
        .select(*kept, "currency", "order.*", "rated.*").withColumn("rate_currency", F.col("currency"))
        .withColumn("res", F.col("rate").cast("bigint") * F.col("amount")).select(*kept, *more, *CONVERTED)
    )


def sales_sums(
    orders: DataFrame, rates: DataFrame, width: Duration = JOIN_WINDOW,
    size: Duration = SALES_SIZE, slide: Duration = SALES_SLIDE,
    order_delay: Duration = ASCENDING_DELAY, rate_delay: Duration = RATE_DELAY, ts: str = "ts",
) -> DataFrame:
    """``item_id, window_end, allsum``, as in batch: both sides are summed per window before they
    meet, so the join's state holds totals and not the rows of the feeds.

    The slide must be a multiple of the join window, for a window's totals to fall into the same
    sliding windows as its rows.
    """
    if positive_micros(slide) % positive_micros(width) or positive_micros(size) % positive_micros(width):
        raise ValueError("size and slide must be multiples of the join window")
    amounts = window_agg(
        with_delay(orders, ts, order_delay).where(keeping_the_clock(F.col("currency").isNotNull())),
        ["currency", "category", "subcat"], ts, width, width, F.sum("amount").alias("amounts"),
    )
    rate_sums = window_agg(
        with_delay(rates, ts, rate_delay).where(keeping_the_clock(F.col("currency").isNotNull())),
        ["currency"], ts, width, width, F.sum("rate").alias("rates"),
    )
    totals = amounts.join(rate_sums, ["w", "currency"], "inner").select(
        "w", "category", "subcat", (F.col("amounts") * F.col("rates")).alias("res")
    )
    sums = window_agg(
        totals, ["category", "subcat"], F.window_time("w"), size, slide, F.sum("res").alias("allsum")
    )
    return window_end(sums).select(item_id(), "window_end", "allsum")
