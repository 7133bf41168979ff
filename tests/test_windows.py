from __future__ import annotations

import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.feeds import BASE, at, rows
from tidemark.operators import windows
from tidemark.operators.joins import key_join_counts, one_row_per_pair, session_window_join
from tidemark.operators.lateness import drop_late, mark_late
from tidemark.operators.topn import top_n
from tidemark.plans.hot_items import hot_items, hot_items_report
from tidemark.plans.sessions import user_self_join

EPOCH = datetime(1970, 1, 1)


def table(spark, records):
    return spark.createDataFrame(
        [(k, EPOCH + timedelta(microseconds=us), v) for k, us, v in records],
        "key string, ts timestamp_ntz, v bigint",
    )


def us_of(ts):
    return (ts - EPOCH) // timedelta(microseconds=1)


def brute_sliding(records, size, slide):
    totals = defaultdict(lambda: [0, 0])
    for key, us, v in records:
        start = us - us % slide
        while start > us - size:
            totals[key, start + size][0] += 1
            totals[key, start + size][1] += v
            start -= slide
    return sorted((k, e, n, s) for (k, e), (n, s) in totals.items())


def brute_sessions(records, gap):
    """[(key, [records])] with records in time order."""
    by_key = defaultdict(list)
    for r in records:
        by_key[r[0]].append(r)
    sessions = []
    for key, rs in by_key.items():
        rs.sort(key=lambda r: r[1])
        for r in rs:
            if sessions and sessions[-1][0] == key and r[1] - sessions[-1][1][-1][1] <= gap:
                sessions[-1][1].append(r)
            else:
                sessions.append((key, [r]))
    return sessions


feed = st.lists(
    st.tuples(st.sampled_from("ab"), st.integers(-300, 3000), st.integers(-5, 5)), min_size=1, max_size=60
)
SLOW = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SLOW
@given(feed, st.sampled_from([(60, 5), (30, 10), (70, 15), (10, 10), (7, 3)]))
def test_sliding_both_forms_against_brute_force(spark, records, window):
    size, slide = window
    size_d, slide_d = timedelta(microseconds=size), timedelta(microseconds=slide)
    for panes in (True, False):
        got = windows.sliding_agg(
            table(spark, records), ["key"], "ts", size_d, slide_d,
            {"n": ("count", None), "s": ("sum", "v")}, panes,
        )
        assert sorted((r.key, us_of(r.window_end), r.n, r.s) for r in got.collect()) == brute_sliding(
            records, size, slide
        )


@SLOW
@given(feed, st.sampled_from([1, 20, 100]))
def test_sessions_against_brute_force_and_session_window(spark, records, gap):
    df = table(spark, records)
    gap_d = timedelta(microseconds=gap)
    got = windows.session_count(df, ["key"], "ts", gap_d)
    want = sorted(
        (k, rs[0][1], rs[-1][1] + gap, len(rs)) for k, rs in brute_sessions(records, gap)
    )
    assert sorted((r.key, us_of(r.session_start), us_of(r.session_end), r.n) for r in got.collect()) == want
    built_in = df.groupBy("key", F.session_window("ts", f"{gap} microseconds").alias("s")).count()
    assert sorted((r.key, us_of(r.s.start), us_of(r.s.end), r["count"]) for r in built_in.collect()) == want


@SLOW
@given(feed, feed, st.sampled_from([1, 20, 100]))
def test_session_join_against_brute_force(spark, left, right, gap):
    got = session_window_join(
        table(spark, left), table(spark, right), "key", "ts", timedelta(microseconds=gap), {"a": "v"}, {"b": "v"}
    )
    tagged = [(k, us, ("l", v)) for k, us, v in left] + [(k, us, ("r", v)) for k, us, v in right]
    want = sorted(
        (key, rs[0][1], rs[-1][1] + gap, x[2][1], y[2][1])
        for key, rs in brute_sessions(tagged, gap)
        for x in rs if x[2][0] == "l"
        for y in rs if y[2][0] == "r"
    )
    assert sorted(
        (r.key, us_of(r.session_start), us_of(r.session_end), r.a, r.b) for r in got.collect()
    ) == want


def test_session_join_fixture(spark):
    schema = "key int, ts timestamp_ntz, v string"
    left = spark.createDataFrame(
        [(k, at(s), v) for k, s, v in [(1, 0, "a"), (1, 500, "b"), (1, 1100, "c"), (2, 0, "x"), (9, 9000, "z")]], schema)
    right = spark.createDataFrame(
        [(k, at(s), v) for k, s, v in [(1, 300, "p"), (1, 1750, "q"), (2, 900, "y"), (9, 9000, "z"), (None, 0, "n")]], schema)
    got = session_window_join(left, right, "key", "ts", "10 minutes", {"l": "v"}, {"r": "v"})
    assert rows(got, "key", "l", "r") == [(1, "a", "p"), (1, "b", "p"), (1, "c", "p"), (9, "z", "z")]
    first = got.where("key = 1").first()
    assert (first.session_start, first.session_end) == (at(0), at(1700))


def test_gap_is_inclusive(spark):
    df = table(spark, [("k", 0, 1), ("k", 100, 1), ("k", 201, 1)])
    got = windows.session_count(df, ["key"], "ts", timedelta(microseconds=100))
    assert rows(got, "n") == [(1,), (2,)]


def test_tumbling_before_1970(spark):
    df = spark.sql("SELECT timestamp_ntz'1969-12-31 23:59:59.999' AS ts")
    got = windows.tumbling_count(df, [], "ts", "10 seconds").first()
    assert (got.window_start, got.n) == (datetime(1969, 12, 31, 23, 59, 50), 1)


def test_windows_must_not_leave_gaps(spark):
    with pytest.raises(ValueError):
        windows.sliding_count(table(spark, [("k", 0, 1)]), ["key"], "ts", "5 seconds", "10 seconds")


@pytest.mark.parametrize("block", [1, 3, 4096])
@pytest.mark.parametrize("delay", [0, 1_000, 3_500])
def test_late_rows_against_brute_force(spark, block, delay):
    rnd = random.Random(7)
    records = [(rnd.choice(["a", "a", "a", "b", None]), i // 2, i, rnd.randrange(100_000) + 40 * i) for i in range(600)]
    df = spark.createDataFrame(
        [(s, a, i, EPOCH + timedelta(milliseconds=ms)) for s, a, i, ms in records],
        "source string, arrival bigint, id bigint, ts timestamp_ntz",
    )
    args = dict(source=["source"], arrival="arrival", ties=["id"], ts="ts", window="10 seconds",
                delay=timedelta(milliseconds=delay), block=block)
    want, seen = {}, {}
    for source, arrival, i, ms in sorted(records, key=lambda r: (r[1], r[2])):
        want[i] = source in seen and (ms // 10_000 + 1) * 10_000 <= seen[source] - delay
        seen[source] = max(seen.get(source, ms), ms)
    assert {r.id: r.late for r in mark_late(df, **args).collect()} == want
    assert any(want.values())
    assert drop_late(df, **args).count() == sum(not late for late in want.values())


def test_top_n_ties_short_groups_and_large_n(spark):
    df = spark.createDataFrame(
        [("w", i, m) for i, m in [(1, 5), (2, 5), (3, 9), (4, 1)]] + [("x", 1, 1)], "w string, item int, m bigint"
    )
    assert rows(top_n(df, ["w"], "m", 3, ["item"]), "w", "rk", "item") == [
        ("w", 1, 3), ("w", 2, 1), ("w", 3, 2), ("x", 1, 1)
    ]
    assert rows(top_n(df, ["w"], "m", 2, ["item"], ascending=True), "w", "rk", "item") == [
        ("w", 1, 4), ("w", 2, 1), ("x", 1, 1)
    ]
    big = spark.range(20_000).select(F.lit("w").alias("w"), (F.col("id") % 7000).alias("m"), "id")
    plain = top_n(big, ["w"], "m", 1500, ["id"])
    want = sorted(((i % 7000, i) for i in range(20_000)), key=lambda r: (-r[0], r[1]))[:1500]
    assert rows(plain, "rk", "m", "id") == [(i + 1, *r) for i, r in enumerate(want)]


def test_measure_beyond_32_bits_sorts_right(spark):
    df = spark.createDataFrame([("w", 1, 5), ("w", 2, 3_000_000_005)], "w string, item int, m bigint")
    assert rows(top_n(df, ["w"], "m", 1, ["item"]), "item") == [(2,)]


def test_key_join_counts(spark):
    left = spark.createDataFrame([(1,), (1,), (2,), (None,)], "user_id int")
    right = spark.createDataFrame([(1,), (1,), (1,), (3,), (None,)], "user_id int")
    counts = key_join_counts(left, right, "user_id")
    assert rows(counts, "user_id", "n_left", "n_right") == [(1, 2, 3)]
    assert one_row_per_pair(counts).count() == left.join(right, "user_id").count() == 6


def test_self_join_lines(spark):
    df = spark.createDataFrame([(1,), (1,), (7,)], "user_id bigint")
    printed = one_row_per_pair(user_self_join(df))
    assert Counter(r.msg for r in printed.collect()) == {"1 joined 1": 4, "7 joined 7": 1}


def test_report_text(spark):
    views = [(7, 3), (5, 2), (9, 1)]
    df = spark.createDataFrame(
        [(item, at(1), "pv") for item, n in views for _ in range(n)] + [(4, at(1), "buy"), (4, at(1), None)],
        "item_id bigint, ts timestamp_ntz, behavior string",
    )
    reports = hot_items_report(hot_items(df)).orderBy("window_end").collect()
    assert len(reports) == 12
    assert reports[0].window_end == BASE + timedelta(minutes=5)
    assert reports[0].report == (
        "====================================\n"
        "时间: 2024-01-01 00:05:00.0\n"
        "No0:  商品ID=7  浏览量=3\n"
        "No1:  商品ID=5  浏览量=2\n"
        "No2:  商品ID=9  浏览量=1\n"
        "====================================\n\n"
    )
