"""Plans and skew: what has to hold when one key has a third of all rows."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tests.feeds import at, rows
from tidemark.operators.joins import _lots, session_window_join, tumbling_window_join
from tidemark.operators.lateness import mark_late
from tidemark.operators.windows import session_count, sliding_count
from tidemark.plans import registry
from tidemark.plans.hot_items import hot_items
from tidemark.plans.sessions import user_sessions
from tidemark.session import checkpoint_location
from tidemark.sources.tables import behavior_feed, events

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in registry.QUERIES if not n.startswith("stream_")))
def test_no_python_no_cartesian_and_pruned_scans(spark, name):
    text = plan(contract.queries()[name](spark, SF_DIR))
    for bad in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in text
    for scan in text.splitlines():
        if "FileScan parquet" in scan:
            if "event_type" in scan:
                assert "EqualTo(event_type" in scan
            columns = re.search(r"FileScan parquet \[(.*?)\]", scan).group(1).split(",")
            assert len(columns) < 6


@pytest.mark.parametrize("name", ["hot_items_topn", "order_topn", "order_bottomn"])
def test_rankings_are_cut_before_the_shuffle(spark, name):
    text = plan(contract.queries()[name](spark, SF_DIR))
    assert re.search(r"WindowGroupLimit .*Partial", text) and re.search(r"WindowGroupLimit .*Final", text)


def test_views_are_combined_before_any_shuffle(spark):
    df = hot_items(behavior_feed(events(spark, SF_DIR), "pv"))
    lines = plan(df).splitlines()
    first_shuffle = max(i for i, line in enumerate(lines) if "Exchange" in line)
    assert "partial_count" in lines[first_shuffle + 1]
    # Nothing but null and type checks is evaluated per row to find the windows.
    assert not any("sequence" in line for line in lines[first_shuffle:])
    assert sum("Exchange" in line for line in lines) == 3


def skewed(spark, n, hot, span):
    """A third of all rows are of one key, and copies of a handful of rows."""
    return spark.range(0, n, 1, 8).select(
        F.when(F.col("id") % 3 == 0, hot).otherwise(F.col("id") % 1000).alias("k"),
        (F.lit(at(0)) + F.expr(f"make_dt_interval(0, 0, 0, (id * 7919) % {span})")).cast("timestamp_ntz").alias("ts"),
        (F.col("id") % 4).alias("v"),
    )


def partition_sizes(df):
    counted = df.groupBy(F.spark_partition_id().alias("p")).count().collect()
    return sorted(r["count"] for r in counted)


@pytest.mark.parametrize("listed", [1, 10_000])
def test_hot_group_of_a_window_join_is_cut_up(spark, listed):
    left = skewed(spark, 6000, 5, 30).select("k", "ts", F.col("v").alias("a"))
    right = skewed(spark, 600, 5, 30).select("k", "ts", F.col("v").alias("b"))
    plain = tumbling_window_join(left, right, "k", "ts", "10 seconds")
    cut = tumbling_window_join(left, right, "k", "ts", "10 seconds", cell_rows=50, listed=listed)
    columns = ["k", "window_start", "window_end", "a", "b"]
    assert plain.count() > 130_000
    assert plain.groupBy(columns).count().exceptAll(cut.groupBy(columns).count()).isEmpty()
    assert cut.groupBy(columns).count().exceptAll(plain.groupBy(columns).count()).isEmpty()
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        group = "k = 5 and window_start = timestamp_ntz'2024-01-01 00:00:00'"
        assert len(partition_sizes(plain.select("*").where(group))) == 1
        cut = tumbling_window_join(left, right, "k", "ts", "10 seconds", cell_rows=50, listed=listed)
        assert len(partition_sizes(cut.where(group))) > 1
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_hot_session_is_cut_up(spark):
    left, right = skewed(spark, 3000, 5, 300), skewed(spark, 300, 5, 300)
    args = ("k", "ts", "60 seconds", {"a": "v"}, {"b": "v"})
    plain = session_window_join(left, right, *args)
    cut = session_window_join(left, right, *args, cell_rows=50)
    assert plain.count() == cut.count() > 100_000
    assert rows(plain.groupBy(plain.columns).count(), *plain.columns, "count") == rows(
        cut.groupBy(plain.columns).count(), *plain.columns, "count")


@pytest.mark.parametrize("parts", [1, 7])
def test_cells_hold_when_rows_come_in_another_order(spark, parts):
    """Where a row goes follows from its content: not from its task, its order or a random number."""
    left = skewed(spark, 3000, 5, 30).select("k", "ts", F.col("v").alias("a"))
    right = skewed(spark, 600, 5, 30).select("k", "ts", F.col("v").alias("b"))
    plain = tumbling_window_join(left, right, "k", "ts", "10 seconds")
    cut = tumbling_window_join(left.repartition(parts, "a"), right.orderBy("b").repartition(parts), "k", "ts",
                               "10 seconds", cell_rows=50)
    columns = ["k", "window_start", "a", "b"]
    assert rows(plain.groupBy(columns).count(), *columns, "count") == rows(cut.groupBy(columns).count(), *columns, "count")
    for unstable in ("monotonically", "rand(", "SPARK_PARTITION_ID"):
        assert unstable not in plan(cut)


def test_copies_in_a_large_group_are_dealt_out(spark):
    """5,000 copies of one row meet 40 of another: every pair is there, and no lot has more than 50 rows."""
    def copies(n, name):
        return spark.range(n).select(F.lit(1).alias("k"), F.lit(at(0)).cast("timestamp_ntz").alias("ts"), F.lit(7).alias(name))

    cut = tumbling_window_join(copies(5000, "a"), copies(40, "b"), "k", "ts", "10 seconds", cell_rows=50)
    assert cut.count() == 200_000 and cut.distinct().count() == 1
    lots = _lots(copies(5000, "a"), ["k", "ts", "a"], 50).collect()
    assert {r["_copies"] for r in lots} == {50} and len({r["_row"] for r in lots}) == 100
    assert session_window_join(copies(500, "a"), copies(40, "b"), "k", "ts", "60 seconds", {"x": "a"}, {"y": "b"},
                               cell_rows=30).count() == 20_000


def test_a_session_self_join_reads_its_table_twice(spark):
    ev = behavior_feed(events(spark, SF_DIR))
    joined = user_sessions(ev, ev, "6 hours")
    joined.collect()
    final = joined._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("FileScan") <= 2


@pytest.mark.parametrize("name", sorted(n for n in registry.QUERIES
                                        if not n.startswith("stream_") and n != "parse_behavior_csv"))
def test_building_a_query_starts_no_job(spark, name):
    spark.sparkContext.setJobGroup(f"build-{name}", name)
    try:
        registry.QUERIES[name](spark, SF_DIR)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup(f"build-{name}")
    finally:
        spark.sparkContext._jsc.clearJobGroup()


def test_lateness_of_a_hot_source_with_dense_arrivals(spark):
    """200,000 rows of one source, or of none, on five arrival values: no task orders them."""
    df = spark.range(0, 200_000, 1, 8).select(
        F.when(F.col("id") % 2 == 0, "s").alias("source"), (F.col("id") % 5).alias("arrival"),
        "id", (F.lit(at(0)) + F.expr("make_dt_interval(0, 0, 0, (id * 7919) % 3600)")).cast("timestamp_ntz").alias("ts"))
    marked = mark_late(df, ["source"], "arrival", ["id"], "ts", "10 seconds", "600 seconds")
    order = Window.partitionBy("source").orderBy("arrival", "id").rowsBetween(Window.unboundedPreceding, -1)
    plain = df.withColumn("seen", F.max("ts").over(order)).withColumn("late", F.coalesce(
        F.expr("window(ts, '10 seconds').end <= seen - interval 600 seconds"), F.lit(False)))
    counted = ["source", "arrival", "late"]
    got = rows(marked.na.fill("", ["source"]).groupBy(counted).count(), *counted, "count")
    assert got == rows(plain.na.fill("", ["source"]).groupBy(counted).count(), *counted, "count")
    assert {r[2] for r in got} == {True, False}
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        marked = mark_late(df, ["source"], "arrival", ["id"], "ts", "10 seconds", "600 seconds")
        assert max(partition_sizes(marked)) < 100_000
        # Ordered are windows, of which there are 360 a source, and blocks of them.
        for window in re.findall(r"Window \[.*", plan(marked)):
            assert "arrival" not in window.split("windowspecdefinition")[0]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("name", ["parse_order_feed", "parse_rate_feed"])
def test_a_line_is_split_once(spark, name):
    assert plan(registry.QUERIES[name](spark, SF_DIR)).count("split(") == 1


def test_session_pass_sees_panes_not_rows(spark):
    """A hot key's ordered pass is over one row per pane."""
    df = skewed(spark, 30_000, 5, 300)
    counts = session_count(df, ["k"], "ts", "60 seconds").where("k = 5")
    assert counts.first().n == df.where("k = 5").count()
    text = plan(counts)
    assert text.index("Window") < text.index("partial_min")
    assert session_count(df, ["k"], "ts", "60 seconds").agg(F.sum("n")).first()[0] == 30_000


def test_hot_item_counts(spark):
    df = skewed(spark, 30_000, 5, 3000)
    a = sliding_count(df, ["k"], "ts", "10 minutes", "1 minute")
    b = sliding_count(df, ["k"], "ts", "10 minutes", "1 minute", panes=False)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_a_hot_partition_is_split_by_aqe(spark):
    """The placement joins have one row per group on one side; AQE splits the other by size."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10000",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        left = skewed(spark, 60_000, 5, 30)
        right = skewed(spark, 60, 5, 30)
        joined = session_window_join(left, right, "k", "ts", "60 seconds", {"a": "v"}, {"b": "v"})
        total = joined.count()
        q = joined.groupBy("a").count()
        q.collect()
        assert "skew=true" in plan(q)
        assert total == joined.where("a >= 0").count()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_zone_less_times_need_utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        with pytest.raises(ValueError, match="UTC"):
            session_count(events(spark, SF_DIR), ["user_id"], "ts", "6 hours")
        # Instants mean the same anywhere.
        df = spark.sql("SELECT timestamp'2024-01-01 00:00:00+00:00' AS ts")
        end = sliding_count(df, [], "ts", "10 seconds", "10 seconds").selectExpr("unix_seconds(window_end)")
        assert end.first()[0] == 1_704_067_210
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_checkpoints_go_to_the_named_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert checkpoint_location(spark, "q") == f"{named}/q"
