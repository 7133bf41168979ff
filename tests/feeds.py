"""Hand-made feeds. Offsets are in seconds from BASE."""

from __future__ import annotations

import os
from datetime import datetime, timedelta

from tidemark.functions.codecs import decode_orders, decode_rates
from tidemark.functions.eventtime import from_epoch_millis
from tidemark.sources.feeds import text_lines

BASE = datetime(2024, 1, 1)
BASE_MS = 1_704_067_200_000


def at(seconds):
    return BASE + timedelta(seconds=seconds)


def order_line(record):
    offset, category, subcat, currency, amount = record
    return f"{BASE_MS + int(offset * 1000)},{category},{subcat},{currency},{amount}"


def rate_line(record):
    offset, currency, rate = record
    return f"{BASE_MS + int(offset * 1000)},{currency},{rate}"


def write_batches(folder, batches):
    """One file per batch, in order of modification time."""
    os.makedirs(folder)
    for i, lines in enumerate(batches):
        path = os.path.join(folder, f"part-{i:04d}.txt")
        with open(path, "w") as out:
            out.write("".join(line + "\n" for line in lines))
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))
    return str(folder)


def timed(df):
    return df.withColumn("ts", from_epoch_millis("ts_ms"))


def order_stream(spark, folder, batches):
    path = write_batches(folder, [[order_line(r) for r in b] for b in batches])
    return timed(decode_orders(text_lines(spark, path, max_files_per_trigger=1)))


def rate_stream(spark, folder, batches):
    path = write_batches(folder, [[rate_line(r) for r in b] for b in batches])
    return timed(decode_rates(text_lines(spark, path, max_files_per_trigger=1)))


def order_table(spark, batches):
    lines = [(order_line(r),) for b in batches for r in b]
    return timed(decode_orders(spark.createDataFrame(lines, "value string")))


def rate_table(spark, batches):
    lines = [(rate_line(r),) for b in batches for r in b]
    return timed(decode_rates(spark.createDataFrame(lines, "value string")))


def run(writer):
    query = writer.trigger(availableNow=True).start()
    assert query.awaitTermination(300)
    return query


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())
