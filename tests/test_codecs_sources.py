from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.feeds import rows, run, write_batches
from tidemark.functions import codecs
from tidemark.functions.durations import common_pane, micros
from pyspark.sql.types import TimestampType
from tidemark.functions.eventtime import (
    as_time, epoch_millis, epoch_seconds, from_epoch_millis, from_epoch_seconds, pane_of,
)
from tidemark.sources.feeds import csv_records, csv_twice, kafka_lines, text_lines
from tidemark.sources.schemas import BEHAVIOR, EVENT, ORDER, RATE
from tidemark.streaming import sinks


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_decode(spark):
    got = codecs.decode_rates(lines(spark, "1,CNY,2", "5,USD,-3,extra,fields"))
    assert got.dtypes == [("ts_ms", "bigint"), ("currency", "string"), ("rate", "int")]
    assert rows(got, *got.columns) == [(1, "CNY", 2), (5, "USD", -3)]
    got = codecs.decode_orders(lines(spark, "1,A,3,USD,999"))
    assert rows(got, *got.columns) == [(1, "A", 3, "USD", 999)]


BAD = ["1,CNY", "x,CNY,1", "1,CNY,1.5", "", "1,CNY,99999999999", None]


@pytest.mark.parametrize("bad", BAD)
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_strict_fails(spark, bad, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="not a record of"):
            codecs.decode_rates(lines(spark, "1,CNY,2", bad)).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


@pytest.mark.parametrize("bad", [*BAD, "1,CNY, 2"])
@pytest.mark.parametrize("use", [
    lambda df: df.count(), lambda df: df.select("currency").collect(),
    lambda df: df.groupBy("currency").count().collect()])
def test_strict_fails_whatever_is_used(spark, bad, use):
    with pytest.raises(Exception, match="not a record of"):
        use(codecs.decode_rates(lines(spark, "1,CNY,2", bad)))


@pytest.mark.parametrize("bad", ["x,2,3,pv,5", "1,2,3,pv", "1,2,3,pv,5,6", "1, 2,3,pv,5"])
@pytest.mark.parametrize("use", [
    lambda df: df.count(), lambda df: df.select("item_id", "behavior").collect(),
    lambda df: df.groupBy("behavior").count().collect()])
def test_csv_fails_whatever_is_used(spark, tmp_path, bad, use):
    (tmp_path / "feed.csv").write_text(f"1,2,3,pv,5\n\n{bad}\n")
    with pytest.raises(Exception, match="not a record of"):
        use(csv_records(spark, str(tmp_path)))


def test_quarantine_keeps_everything(spark):
    good, bad = codecs.decode_quarantine(lines(spark, "1,CNY,2", *BAD), RATE)
    assert rows(good, *good.columns) == [(1, "CNY", 2)]
    assert sorted(r.value or "" for r in bad.collect()) == sorted(v or "" for v in BAD)


def test_quarantine_on_a_stream(spark, tmp_path):
    path = write_batches(tmp_path / "in", [["1,CNY,2", "x"], ["3,USD,4", "5"]])
    good, bad = codecs.decode_quarantine(text_lines(spark, path, max_files_per_trigger=1), RATE)
    run(sinks.to_files(good, "quarantine-good", str(tmp_path / "good")))
    run(sinks.to_files(bad, "quarantine-bad", str(tmp_path / "bad"), "text"))
    assert rows(spark.read.parquet(str(tmp_path / "good")), "ts_ms") == [(1,), (3,)]
    assert rows(spark.read.text(str(tmp_path / "bad")), "value") == [("5",), ("x",)]


def test_encode_is_the_inverse(spark):
    values = ["1,A,3,USD,999", "-5,E,0,ITL,0"]
    assert rows(codecs.encode_orders(codecs.decode_orders(lines(spark, *values))), "value") == [
        (v,) for v in sorted(values)
    ]
    assert codecs.encode_rates(codecs.decode_rates(lines(spark, "1,CNY,2"))).first().value == "1,CNY,2"


def test_csv(spark, tmp_path):
    path = write_batches(tmp_path / "csv", [["1,10,100,pv,1704067200", "2,20,200,buy,1704067201"]])
    got = csv_records(spark, path)
    assert got.columns == BEHAVIOR.names
    assert rows(got, *got.columns) == [(1, 10, 100, "pv", 1704067200), (2, 20, 200, "buy", 1704067201)]
    left, right = csv_twice(spark, path)
    joined = left.join(right, F.col("left.user_id") == F.col("right.user_id"))
    assert joined.count() == 2


@pytest.mark.parametrize("bad", ["1,10,100,pv", "1,10,x,pv,1", "1,10,100,pv,1,extra"])
def test_csv_fails_on_a_malformed_line(spark, tmp_path, bad):
    path = write_batches(tmp_path / "csv", [["1,10,100,pv,1704067200", bad]])
    with pytest.raises(Exception, match="(?i)malformed"):
        csv_records(spark, path).collect()


def test_csv_as_two_streams(spark, tmp_path):
    path = write_batches(tmp_path / "csv", [["1,10,100,pv,1"], ["2,20,200,buy,2"]])
    left, right = csv_twice(spark, path, streaming=True, max_files_per_trigger=1)
    assert left.isStreaming and right.isStreaming
    run(sinks.to_files(left, tmp_path.name, str(tmp_path / "out")))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_kafka_reader_asks_for_the_topic(spark):
    # The connector is not installed here, so only the request for it can be checked.
    with pytest.raises(Exception, match="(?i)kafka"):
        kafka_lines(spark, "rate")


def test_event_schema(spark):
    ev = spark.createDataFrame([("a", 1, "g", 1704067200123, None)], EVENT)
    assert ev.select(from_epoch_millis("create_time").alias("t")).first().t == datetime(2024, 1, 1, 0, 0, 0, 123000)
    assert ORDER.names == ["ts_ms", "category", "subcat", "currency", "amount"]


def test_event_time(spark):
    df = spark.sql("SELECT -1L AS ms, -1L AS s, timestamp'1969-12-31 23:59:59.9995' AS ts")
    got = df.select(
        from_epoch_millis("ms").alias("a"), from_epoch_seconds("s").alias("b"),
        epoch_millis("ts").alias("c"), epoch_seconds("ts").alias("d"), as_time(pane_of("ts", "10 seconds"), TimestampType()).alias("e"),
    ).first()
    assert got.a == datetime(1969, 12, 31, 23, 59, 59, 999000)
    assert got.b == datetime(1969, 12, 31, 23, 59, 59)
    assert (got.c, got.d) == (-1, -1)
    assert got.e == datetime(1969, 12, 31, 23, 59, 50)


def test_durations():
    assert micros("10 seconds") == 10_000_000
    assert micros("1 hour 30 minutes") == 5_400_000_000
    assert micros("3500 milliseconds") == 3_500_000
    assert common_pane("60 minutes", "5 minutes") == "300000000 microseconds"
    assert common_pane("70 minutes", "15 minutes") == "300000000 microseconds"
    for wrong in ("", "ten seconds", "1 month", "1 second ago", "5"):
        with pytest.raises(ValueError):
            micros(wrong)
