from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.feeds import BASE_MS, at, order_stream, order_table, rate_stream, rate_table, rows, run, timed
from tidemark.plans import conversion as batch
from tidemark.plans import registry
from tidemark.streaming import conversion as stream
from tidemark.streaming import ranking, sinks, watermarks

ORDERS = [
    [(1, "A", 3, "USD", 10), (2, "A", 3, "CNY", 100)],
    [(1.5, "A", 3, "USD", 999), (9, "B", 1, "USD", 7)],
    [(12, "B", 1, "CNY", 1), (25, "C", 0, "USD", 5)],
]
RATES = [
    [(0.5, "USD", 3), (3, "CNY", 2)],
    [(8, "USD", 4), (11, "CNY", 5)],
    [(26, "USD", 6)],
]
CLOSING_ORDERS = [[(600, "Z", 9, "ZZZ", 0)]]
CLOSING_RATES = [[(600, "YYY", 0)]]

SUMS = [
    ("A3", at(10), 7263), ("A3", at(20), 7263), ("A3", at(30), 7263),
    ("B1", at(10), 49), ("B1", at(20), 54), ("B1", at(30), 54), ("B1", at(40), 5),
    ("C0", at(30), 30), ("C0", at(40), 30), ("C0", at(50), 30),
]


def streams(spark, tmp_path, orders, rates):
    return order_stream(spark, tmp_path / "orders", orders), rate_stream(spark, tmp_path / "rates", rates)


def test_batch_pairs(spark):
    pairs = batch.converted_orders(order_table(spark, ORDERS), rate_table(spark, RATES))
    assert rows(pairs, "category", "currency", "amount", "res") == [
        ("A", "CNY", 100, 200), ("A", "USD", 10, 30), ("A", "USD", 10, 40),
        ("A", "USD", 999, 2997), ("A", "USD", 999, 3996),
        ("B", "CNY", 1, 5), ("B", "USD", 7, 21), ("B", "USD", 7, 28), ("C", "USD", 5, 30),
    ]
    first = pairs.where("amount = 10 and rate = 3").first()
    assert (first.ts_ms, first.rate_ts_ms, first.rate_currency) == (BASE_MS + 1000, BASE_MS + 500, "USD")


def test_batch_sums(spark):
    for sums in (batch.sales_sums, batch.sales_sums_by_pairs):
        got = sums(order_table(spark, ORDERS), rate_table(spark, RATES))
        assert rows(got, "item_id", "window_end", "allsum") == SUMS


def test_batch_ranking(spark):
    orders, rates = order_table(spark, ORDERS), rate_table(spark, RATES)
    top = batch.sales_ranking(orders, rates, n=2).where(f"window_end = '{at(30)}'")
    assert rows(top, "rk", "item_id") == [(1, "A3"), (2, "B1")]
    bottom = batch.sales_ranking(orders, rates, n=2, ascending=True).where(f"window_end = '{at(30)}'")
    assert rows(bottom, "rk", "item_id") == [(1, "C0"), (2, "B1")]


def test_stream_pairs_equal_batch(spark, tmp_path):
    orders, rates = streams(spark, tmp_path, ORDERS + CLOSING_ORDERS, RATES + CLOSING_RATES)
    run(sinks.to_files(stream.converted_orders(orders, rates).drop("w"), tmp_path.name, str(tmp_path / "out")))
    want = batch.converted_orders(order_table(spark, ORDERS), rate_table(spark, RATES))
    assert rows(spark.read.parquet(str(tmp_path / "out")), *want.columns) == rows(want, *want.columns)


@pytest.mark.parametrize("side", ["orders", "rates"])
def test_a_hot_currency_spreads_whichever_side_it_is_on(spark, side):
    """One window and currency with 6,000 rows on one side: they meet the other side in several cells, each
    pair once, and in the same ones whatever the order of the rows."""
    orders = spark.range(6000 if side == "orders" else 40).select(
        (F.lit(BASE_MS) + F.col("id")).alias("ts_ms"), F.lit("A").alias("category"), F.lit(1).alias("subcat"),
        F.lit("USD").alias("currency"), F.col("id").cast("int").alias("amount"))
    rates = spark.range(6000 if side == "rates" else 40).select(
        (F.lit(BASE_MS) + F.col("id")).alias("ts_ms"), F.lit("USD").alias("currency"), F.col("id").cast("int").alias("rate"))
    def joined(*dealt):
        return stream.converted_orders(timed(orders.repartition(*dealt)), timed(rates.repartition(*dealt)))
    pairs = joined(3)
    assert pairs.count() == 240_000 == pairs.select("amount", "rate").distinct().count()
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "64"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        sizes = [sorted(r["count"] for r in joined(n).groupBy(F.spark_partition_id()).count().collect()) for n in (3, 5)]
        assert sizes[0] == sizes[1] and len(sizes[0]) > 8 and sizes[0][-1] < 60_000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_sides_meet_as_lists_and_the_last_window_comes_out(spark, tmp_path):
    """The join's state holds a few lists per cell however many rows there are; windows that only the end of the
    input closes come out too, with every copy of a row."""
    n = 1500
    orders = [[(1 + i / n, "A", 3, "USD", i % 700) for i in range(n)], [(21, "B", 1, "CNY", 5)] * 2, CLOSING_ORDERS[0]]
    rates = [[(2, "USD", 3), (3, "USD", 4)], [(22, "CNY", 2)] * 2, [(600, None, 0)]]
    lhs, rhs = streams(spark, tmp_path, orders, [[(o, c or "", r) for o, c, r in b] for b in rates])
    query = run(sinks.to_files(stream.converted_orders(lhs, rhs).drop("w"), tmp_path.name, str(tmp_path / "out")))
    want = batch.converted_orders(order_table(spark, orders[:2]), rate_table(spark, rates[:2]))
    assert rows(spark.read.parquet(str(tmp_path / "out")), *want.columns) == rows(want, *want.columns)
    joined = [op.numRowsUpdated for p in query.recentProgress for op in p.stateOperators if "Join" in op.operatorName]
    assert joined and max(joined) < 600


def test_the_streamed_join_writes_lists_and_not_pairs(spark, tmp_path):
    """Its files follow from the rows; the pairs, 300 x 200 of one window, come out whole, with copies and nulls."""
    events = spark.range(500).select(
        F.col("id").alias("event_id"), F.lit("2024-01-01 05:10:00").cast("timestamp_ntz").alias("ts"),
        F.lit(4).cast("bigint").alias("user_id"), F.when(F.col("id") < 300, "purchase").otherwise("click").alias("event_type"),
        F.when(F.col("id") % 50 != 0, (F.col("id") % 90).cast("double")).alias("value"),
        F.when(F.col("id") % 40 != 0, F.concat(F.lit('{"k": '), F.col("id") % 70, F.lit("}"))).alias("props"))
    events.write.parquet(str(tmp_path / "events.parquet"))
    got = registry.QUERIES["stream_tumbling_join"](spark, str(tmp_path))
    want = registry.QUERIES["tumbling_window_join"](spark, str(tmp_path))
    assert got.dtypes == want.dtypes and got.count() == 60_000
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert spark.read.parquet(*got.inputFiles()).count() <= 16 * 16


def test_stream_ranking_equals_batch(spark, tmp_path):
    orders, rates = streams(spark, tmp_path, ORDERS + CLOSING_ORDERS, RATES + CLOSING_RATES)
    query = run(ranking.ranked(
        stream.sales_sums(orders, rates), tmp_path.name,
        lambda sums: batch.rank_sales(sums, 2), sinks.batch_files(str(tmp_path / "out")),
    ))
    want = batch.sales_ranking(order_table(spark, ORDERS), rate_table(spark, RATES), n=2)
    got = spark.read.parquet(str(tmp_path / "out"))
    assert rows(got, *want.columns) == rows(want, *want.columns)
    # The slower of the two watermarks rules: rates trail by a second.
    assert watermarks.event_clock(query)[-1][2].startswith("2024-01-01T00:09:59")
    # State is freed as windows close.
    last = query.lastProgress.stateOperators
    assert all(op.numRowsTotal <= 2 for op in last)


LATE_ORDERS = [
    [(1, "A", 3, "USD", 10), (8, "A", 3, "CNY", 100)],
    [(8.1, "B", 1, "XXX", 7)],
    [(1.5, "A", 3, "USD", 999)],
    [(30, "C", 0, "XXX", 5)], [(31, "C", 0, "XXX", 5)], [(32, "C", 0, "XXX", 5)],
    [(1.6, "A", 3, "USD", 555)],
    [(600, "Z", 9, "ZZZ", 0)],
]
LATE_RATES = [
    [(0.5, "USD", 3), (8.5, "CNY", 2)],
    [(8.6, "YYY", 4)], [(8.7, "YYY", 4)],
    [(32, "YYY", 5)], [(33, "YYY", 5)], [(34, "YYY", 5)], [(34.5, "YYY", 6)],
    [(600, "YYY", 0)],
]


def dropped(query):
    return sum(op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators)


def test_out_of_order_kept_late_dropped(spark, tmp_path):
    orders, rates = streams(spark, tmp_path, LATE_ORDERS, LATE_RATES)
    query = run(sinks.to_files(stream.converted_orders(orders, rates).drop("w"), tmp_path.name, str(tmp_path / "out")))
    assert rows(spark.read.parquet(str(tmp_path / "out")), "res") == [(30,), (200,), (2997,)]
    # Once in each of the columns of cells that it was dealt to.
    assert dropped(query) == 4


def test_sums_drop_the_same_late_row(spark, tmp_path):
    orders, rates = streams(spark, tmp_path, LATE_ORDERS, LATE_RATES)
    query = run(sinks.to_files(stream.sales_sums(orders, rates), tmp_path.name, str(tmp_path / "out")))
    got = rows(spark.read.parquet(str(tmp_path / "out")), "item_id", "window_end", "allsum")
    assert got == [("A3", at(10), 3227), ("A3", at(20), 3227), ("A3", at(30), 3227)]
    assert dropped(query) == 1


def test_slide_must_fit_the_join_window(spark, tmp_path):
    orders, rates = streams(spark, tmp_path, ORDERS, RATES)
    with pytest.raises(ValueError):
        stream.sales_sums(orders, rates, "10 seconds", "30 seconds", "15 seconds")


def test_no_currency_no_pair_and_no_32_bit_overflow(spark):
    orders = order_table(spark, [[(1, "A", 1, "USD", 2_000_000_000), (2, "A", 1, "EUR", 5)]])
    rates = rate_table(spark, [[(1, "USD", 19), (2, "EUR", 1)]])
    orders = orders.withColumn("currency", F.when(F.col("currency") == "USD", "USD"))
    assert rows(batch.converted_orders(orders, rates), "res") == [(38_000_000_000,)]
    for sums in (batch.sales_sums, batch.sales_sums_by_pairs):
        assert rows(sums(orders, rates), "allsum") == [(38_000_000_000,)] * 3
