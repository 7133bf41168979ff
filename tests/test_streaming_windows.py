from __future__ import annotations

import json
import logging
import time

import pytest
from pyspark.sql import functions as F

from tests.feeds import BASE_MS, at, rows, run, timed, write_batches
from tidemark.functions.codecs import decode_rates, encode_rates
from tidemark.functions.eventtime import from_epoch_millis, from_epoch_seconds
from tidemark.operators.joins import session_window_join
from tidemark.operators.windows import sliding_count
from tidemark.plans import hot_items as batch
from tidemark.sources.feeds import csv_records, text_lines
from tidemark.sources.schemas import BEHAVIOR, EVENT
from tidemark.sources.tables import behavior_feed, events
from tidemark.streaming import hot_items as stream
from tidemark.streaming import ranking, sinks, watermarks
from tidemark.streaming.windows import self_session_counts, session_counts, window_agg, window_end

T0 = BASE_MS // 1000


def behavior_line(record):
    offset, user, item, behavior = record
    return f"{user},{item},{item % 10},{behavior},{T0 + offset}"


def with_time(df):
    return df.withColumn("ts", from_epoch_seconds("timestamp"))


VIEWS = [
    [(0, 1, 7, "pv"), (10, 2, 7, "pv"), (20, 1, 5, "pv"), (30, 1, 4, "buy")],
    [(400, 1, 5, "pv"), (390, 2, 5, "pv"), (410, 3, 9, "pv"), (415, 3, 8, "pv")],
    [(3000, 1, 9, "pv")],
    [(20_000, 1, 1, "cart")],
]


def view_stream(spark, folder, batches):
    path = write_batches(folder, [[behavior_line(r) for r in b] for b in batches])
    return with_time(csv_records(spark, path, streaming=True, max_files_per_trigger=1))


def view_table(spark, batches):
    records = [(u, i, i % 10, b, T0 + o) for rows_ in batches for o, u, i, b in rows_]
    return with_time(spark.createDataFrame(records, BEHAVIOR))


def test_hot_items_stream_equals_batch(spark, tmp_path):
    out = str(tmp_path / "out")
    run(ranking.ranked(
        stream.item_views(view_stream(spark, tmp_path / "in", VIEWS)), tmp_path.name,
        batch.rank_items, sinks.batch_files(out),
    ))
    want = batch.hot_items(view_table(spark, VIEWS))
    assert rows(spark.read.parquet(out), *want.columns) == rows(want, *want.columns)


def test_hot_items_stream_on_the_table(spark, tmp_path):
    """Real rows, cut into files by time; the last windows stay open, as nothing later comes."""
    ev = events(spark, "/root/testdata/sf0.001")
    parts = str(tmp_path / "in")
    sinks.batch_files(parts)(ev.where("event_id < 400").coalesce(1), 0)
    sinks.batch_files(parts)(ev.where("event_id >= 400").coalesce(1), 1)
    feed = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(f"{parts}/*")
    out = str(tmp_path / "out")
    typed = behavior_feed(feed).withColumn("ts", F.col("ts").cast("timestamp"))
    run(ranking.ranked(stream.item_views(typed), tmp_path.name, batch.rank_items, sinks.batch_files(out)))
    last = ev.agg(F.max("ts").cast("timestamp")).first()[0]
    want = batch.hot_items(behavior_feed(ev)).withColumn("window_end", F.col("window_end").cast("timestamp"))
    want = want.where(F.col("window_end") <= F.lit(last))
    assert want.count() > 1000
    assert rows(spark.read.parquet(out), *want.columns) == rows(want, *want.columns)


def test_a_late_row_counts_in_its_open_windows(spark, tmp_path):
    batches = [[(0, 1, 7, "pv")], [(420, 1, 5, "cart")], [(421, 1, 5, "cart")], [(422, 1, 5, "cart")],
               [(10, 1, 7, "pv")], [(20_000, 1, 1, "cart")]]
    out = str(tmp_path / "out")
    query = run(sinks.to_files(stream.item_views(view_stream(spark, tmp_path / "in", batches)), tmp_path.name, out))
    want = [(at(300), 1)] + [(at(300 * i), 2) for i in range(2, 13)]
    assert rows(spark.read.parquet(out), "window_end", "view_count") == want
    assert sum(op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators) == 1


def test_a_restarted_query_goes_on(spark, tmp_path):
    out, folder = str(tmp_path / "out"), tmp_path / "in"
    feed = view_stream(spark, folder, VIEWS[:2])

    def start():
        return run(ranking.ranked(
            stream.item_views(feed), tmp_path.name, batch.rank_items, sinks.batch_files(out)))

    start()
    for i, records in enumerate(VIEWS[2:]):
        (folder / f"more-{i}.txt").write_text("".join(behavior_line(r) + "\n" for r in records))
        start()
    want = batch.hot_items(view_table(spark, VIEWS))
    assert rows(spark.read.parquet(out), *want.columns) == rows(want, *want.columns)


def test_timers_rank_as_the_batch_does_and_go_on_after_a_restart(spark, tmp_path):
    out, folder = str(tmp_path / "out"), tmp_path / "in"
    feed = view_stream(spark, folder, VIEWS[:2])
    assert "RocksDB" in spark.conf.get("spark.sql.streaming.stateStore.providerClass")

    def start():
        return run(sinks.to_files(stream.hot_items_by_timer(feed, n=2), tmp_path.name, out))

    start()
    early = spark.read.parquet(out).count()
    for i, records in enumerate(VIEWS[2:]):
        (folder / f"more-{i}.txt").write_text("".join(behavior_line(r) + "\n" for r in records))
        query = start()
    want = batch.hot_items(view_table(spark, VIEWS), n=2)
    columns = ["item_id", "window_end", "view_count", "rk"]
    assert early < want.count()
    assert rows(spark.read.parquet(out), *columns) == rows(want, *columns)
    assert "transformWithState" in json.dumps([p.json for p in query.recentProgress])


def test_the_end_of_the_input_closes_what_is_open(spark, tmp_path):
    """Nothing comes after the last row, and yet all its windows come out; without the end they don't."""
    feed = view_stream(spark, tmp_path / "in", VIEWS[:2])
    want = batch.hot_items(view_table(spark, VIEWS[:2]))
    open_still = str(tmp_path / "out")
    run(ranking.ranked(stream.item_views(feed), tmp_path.name, batch.rank_items, sinks.batch_files(open_still)))
    got = sinks.catch_up(spark, tmp_path.name, lambda name, path, until_end: ranking.ranked(
        stream.item_views(until_end(feed)), name, batch.rank_items, sinks.batch_files(path)))
    assert rows(got, *want.columns) == rows(want, *want.columns)
    assert spark.read.parquet(open_still).count() < want.count()
    sessions = sinks.catch_up(spark, tmp_path.name, lambda name, path, until_end: sinks.to_files(
        self_session_counts(watermarks.ascending(until_end(feed), "ts"), "user_id", "ts", "10 minutes"), name, path))
    assert rows(sessions, "user_id", "session_end", "n_left", "n_right") == [
        (1, at(1000), 4, 4), (2, at(990), 2, 2), (3, at(1015), 2, 2)]


def test_report_on_a_stream(spark, tmp_path):
    out = str(tmp_path / "out")
    run(ranking.ranked(
        stream.item_views(view_stream(spark, tmp_path / "in", VIEWS)), tmp_path.name,
        lambda views: batch.hot_items_report(batch.rank_items(views)), sinks.batch_files(out),
    ))
    want = batch.hot_items_report(batch.hot_items(view_table(spark, VIEWS)))
    assert rows(spark.read.parquet(out), "window_end", "report") == rows(want, "window_end", "report")


def test_session_counts_stream(spark, tmp_path):
    left = [[(0, 1, 1, "cart"), (0, 2, 1, "cart")], [(500, 1, 2, "cart"), (1100, 1, 3, "cart")],
            [(9000, 9, 1, "cart")], [(99_000, 0, 0, "cart")]]
    right = [[(300, 1, 1, "buy")], [(1750, 1, 2, "buy"), (900, 2, 1, "buy")],
             [(9000, 9, 1, "buy")], [(99_000, 8, 0, "buy")]]
    delay = "1000 seconds"
    counts = session_counts(
        watermarks.with_delay(view_stream(spark, tmp_path / "l", left), "ts", delay),
        watermarks.with_delay(view_stream(spark, tmp_path / "r", right), "ts", delay),
        "user_id", "ts", "10 minutes",
    )
    run(sinks.to_files(counts, tmp_path.name, str(tmp_path / "out")))
    got = spark.read.parquet(str(tmp_path / "out"))
    assert rows(got, "user_id", "session_start", "session_end", "n_left", "n_right") == [
        (1, at(0), at(1700), 3, 1), (9, at(9000), at(9600), 1, 1)
    ]
    pairs = session_window_join(
        view_table(spark, left), view_table(spark, right), "user_id", "ts", "10 minutes",
        {"l": "item_id"}, {"r": "item_id"},
    ).groupBy("user_id", "session_start", "session_end").agg(F.count("*").alias("n"))
    assert rows(pairs, "user_id", "session_start", "session_end", "n") == rows(
        got.withColumn("n", F.col("n_left") * F.col("n_right")), "user_id", "session_start", "session_end", "n")


@pytest.mark.parametrize("delay,kept", [
    (watermarks.ASCENDING_DELAY, 1), (watermarks.RATE_DELAY, 1),
    (watermarks.PERIODIC_DELAY, 2), (watermarks.EVENT_DELAY, 2),
])
def test_event_feed_watermarks(spark, tmp_path, delay, kept):
    """A row 2 s behind the clock, in a 1 s window: late unless the delay reaches back far enough."""
    batches = [[1000], [10_000], [10_001], [8000], [60_000], [90_000]]
    lines = [[json.dumps({"id": str(ms), "rank": 0, "group": "g", "create_time": BASE_MS + ms}) for ms in b]
             for b in batches]
    path = write_batches(tmp_path / "in", lines)
    feed = (
        spark.readStream.option("maxFilesPerTrigger", 1).text(path)
        .select(F.from_json("value", EVENT).alias("e")).select("e.*")
        .withColumn("ts", from_epoch_millis("create_time"))
    )
    counts = window_end(window_agg(
        watermarks.with_delay(feed, "ts", delay), ["group"], "ts", "1 second", "1 second",
        F.count(F.lit(1)).alias("n")))
    query = run(sinks.to_files(counts, tmp_path.name, str(tmp_path / "out")))
    ends = {r[0] for r in rows(spark.read.parquet(str(tmp_path / "out")), "window_end")}
    assert (at(9) in ends) == (kept == 2)
    assert at(2) in ends and at(11) in ends
    clock = watermarks.event_clock(query)
    assert clock[0][1] == "2024-01-01T00:00:01.000Z"


def test_event_clock_log(spark, tmp_path, caplog):
    caplog.set_level(logging.INFO, "tidemark.event_clock")
    listener = watermarks.EventClockLog()
    spark.streams.addListener(listener)
    try:
        run(ranking.ranked(
            stream.item_views(view_stream(spark, tmp_path / "in", VIEWS)), tmp_path.name,
            batch.rank_items, sinks.batch_files(str(tmp_path / "out"))))
        for _ in range(50):
            if caplog.records:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    assert any("2024-01-01T" in r.getMessage() for r in caplog.records)


def test_same_function_for_stream_and_table(spark, tmp_path):
    """The direct sliding form is also valid on a watermarked stream."""
    feed = watermarks.ascending(view_stream(spark, tmp_path / "in", VIEWS), "ts")
    counts = sliding_count(feed, ["item_id"], "ts", "60 minutes", "5 minutes", panes=False)
    run(sinks.to_files(counts, tmp_path.name, str(tmp_path / "out")))
    want = sliding_count(view_table(spark, VIEWS[:3]), ["item_id"], "ts", "60 minutes", "5 minutes")
    assert rows(spark.read.parquet(str(tmp_path / "out")), *want.columns) == rows(want, *want.columns)


def test_fan_out_and_text_sinks(spark, tmp_path, capfd):
    path = write_batches(tmp_path / "in", [["1,CNY,2"], ["3,USD,4"]])
    encoded = encode_rates(timed(decode_rates(text_lines(spark, path, max_files_per_trigger=1))))
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    run(sinks.to_each_batch(encoded, tmp_path.name, sinks.fan_out(
        sinks.batch_files(a, "text"), sinks.batch_files(b), sinks.batch_console())))
    want = [("1,CNY,2",), ("3,USD,4",)]
    assert rows(spark.read.text(a), "value") == rows(spark.read.parquet(b), "value") == want
    assert "3,USD,4" in capfd.readouterr().out
    run(sinks.to_files(encoded, tmp_path.name + "-text", str(tmp_path / "c"), "text"))
    assert rows(spark.read.text(str(tmp_path / "c")), "value") == want
    run(sinks.to_console(encoded, tmp_path.name + "-console"))


def test_a_batch_written_again_replaces_itself(spark, tmp_path):
    write = sinks.batch_files(str(tmp_path / "out"))
    df = spark.createDataFrame([("x",)], "value string")
    write(df, 3)
    write(df, 3)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1


def test_kafka_sink_asks_for_the_topic(spark, tmp_path):
    path = write_batches(tmp_path / "in", [["1,CNY,2"]])
    with pytest.raises(Exception, match="(?i)kafka"):
        run(sinks.to_kafka(text_lines(spark, path), tmp_path.name, "rate"))
    with pytest.raises(Exception, match="(?i)kafka"):
        sinks.batch_kafka("rate")(spark.createDataFrame([("x",)], "value string"), 0)

