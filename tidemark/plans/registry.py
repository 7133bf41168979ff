"""The registered queries: each with the SQL that states its result.

Every query runs over the whole ``events`` table. Events are sparse, so the sales ranking uses a
1 hour join window and 3 h / 1 h sliding windows (the same 3 : 1 as its defaults), and sessions end
after 6 hours; hot items keep their default 60 / 5 minutes. Times come out zone-less, in UTC.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.codecs import decode_orders, decode_rates, encode, encode_orders, encode_rates
from tidemark.functions.eventtime import epoch_millis, from_epoch_millis, from_epoch_seconds, naive
from tidemark.operators.lateness import mark_late
from tidemark.operators.windows import session_count, tumbling_count
from tidemark.plans.conversion import converted_orders, rank_sales, sales_ranking, sales_report, sales_sums
from tidemark.plans.hot_items import hot_items, hot_items_report, item_views, page_views, rank_items
from tidemark.plans.sessions import joined_message, user_self_join, user_session_counts, user_sessions
from tidemark.session import checkpoint_location, configure, configure_state_store, shuffles_dropped
from tidemark.sources.feeds import csv_records
from tidemark.sources.schemas import BEHAVIOR
from tidemark.sources.tables import behavior_feed, event_stream, events, orders_feed, rate_feed
from tidemark.streaming import conversion as streaming_conversion
from tidemark.streaming import hot_items as streaming_hot_items
from tidemark.streaming.ranking import ranked
from tidemark.streaming.sinks import REPEATED_LISTS, batch_files, catch_up, to_files
from tidemark.streaming.watermarks import ascending
from tidemark.streaming.windows import self_session_counts

JOIN_WIDTH = "1 hour"
SALES_SIZE = "3 hours"
SALES_SLIDE = "1 hour"
SESSION_GAP = "6 hours"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

# Common table expressions of the feeds.
_K = r"CAST(regexp_extract(props, '[0-9]+') AS INTEGER)"
_CURRENCY = "['BEF','CNY','DEM','EUR','HKD','USD','ITL'][CAST(user_id % 7 + 1 AS INTEGER)]"
_ORDERS = f"""orders_feed AS (
  SELECT event_id, ts, epoch_us(ts) AS us, epoch_us(ts) // 1000 AS ts_ms,
         substr('ABCDE', CAST(user_id % 5 + 1 AS INTEGER), 1) AS category, {_K} % 5 AS subcat,
         {_CURRENCY} AS currency, CAST(round(value * 100) AS INTEGER) AS amount
  FROM events WHERE event_type = 'purchase')"""
_RATES = f"""rate_feed AS (
  SELECT event_id, ts, epoch_us(ts) AS us, epoch_us(ts) // 1000 AS ts_ms,
         {_CURRENCY} AS currency, {_K} % 20 AS rate
  FROM events WHERE event_type = 'click')"""
_BEHAVIOR = f"""behavior_feed AS (
  SELECT event_id, ts, epoch_us(ts) AS us, user_id, CAST({_K} AS BIGINT) AS item_id, {_K} % 10 AS category_id,
         CASE event_type WHEN 'view' THEN 'pv' WHEN 'purchase' THEN 'buy' WHEN 'click' THEN 'cart'
                         WHEN 'signup' THEN 'fav' WHEN 'error' THEN 'other' END AS behavior,
         epoch_us(ts) // 1000000 AS "timestamp"
  FROM events)"""
_PAIRS = f"""{_ORDERS}, {_RATES}, pairs AS (
  SELECT o.us, o.ts_ms, o.category, o.subcat, o.currency, o.amount, r.ts_ms AS rate_ts_ms,
         r.currency AS rate_currency, r.rate, CAST(r.rate AS BIGINT) * o.amount AS res
  FROM orders_feed o JOIN rate_feed r
    ON o.currency = r.currency AND o.us // 3600000000 = r.us // 3600000000)"""
_SALES = f"""{_PAIRS}, sales AS (
  SELECT category || CAST(subcat AS VARCHAR) AS item_id,
         make_timestamp((us // 3600000000 - i + 3) * 3600000000) AS window_end,
         CAST(sum(res) AS BIGINT) AS allsum
  FROM pairs, range(0, 3) t(i) GROUP BY 1, 2)"""
_VIEWS = f"""{_BEHAVIOR}, views AS (
  SELECT item_id, make_timestamp((us // 300000000 - i + 12) * 300000000) AS window_end,
         count(*) AS view_count
  FROM behavior_feed, range(0, 12) t(i) WHERE behavior = 'pv' GROUP BY 1, 2)"""
_HOT = f"""{_VIEWS}, hot AS (
  SELECT * FROM (SELECT *, CAST(row_number() OVER (
    PARTITION BY window_end ORDER BY view_count DESC, item_id) AS INTEGER) AS rk FROM views) WHERE rk <= 3)"""


def _ranked_sales(direction: str) -> str:
    return f"""{_SALES}, ranked AS (
  SELECT * FROM (SELECT *, CAST(row_number() OVER (
    PARTITION BY window_end ORDER BY allsum {direction}, item_id) AS INTEGER) AS rk FROM sales) WHERE rk <= 5)"""


def _report(ranked: str, measure: str, label: str, rank: str) -> str:
    rule = "repeat('=', 36) || chr(10)"
    return f"""
  SELECT window_end, {rule} || '时间: ' || strftime(window_end, '%Y-%m-%d %H:%M:%S') || '.0' || chr(10)
         || string_agg('No' || {rank} || ':  商品ID=' || item_id || '  {label}=' || {measure} || chr(10), ''
                       ORDER BY rk)
         || {rule} || chr(10) AS report
  FROM {ranked} GROUP BY window_end"""


def query(name: str, sql: str | None) -> Callable[[Query], Query]:
    def register(make: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return make(configure(spark), sf_dir)

        QUERIES[name] = run
        if sql:
            ORACLE[name] = sql
        return run

    return register


# --- feeds -----------------------------------------------------------------------------------


@query("encode_order_feed", f"""WITH {_ORDERS}
  SELECT concat_ws(',', ts_ms, category, subcat, currency, amount) AS value FROM orders_feed""")
def _(spark, sf_dir):
    return encode_orders(orders_feed(events(spark, sf_dir)))


@query("encode_rate_feed", f"""WITH {_RATES}
  SELECT concat_ws(',', ts_ms, currency, rate) AS value FROM rate_feed""")
def _(spark, sf_dir):
    return encode_rates(rate_feed(events(spark, sf_dir)))


@query("parse_order_feed", f"""WITH {_ORDERS}
  SELECT ts_ms, category, subcat, currency, amount FROM orders_feed""")
def _(spark, sf_dir):
    return decode_orders(encode_orders(orders_feed(events(spark, sf_dir))))


@query("parse_rate_feed", f"WITH {_RATES} SELECT ts_ms, currency, rate FROM rate_feed")
def _(spark, sf_dir):
    return decode_rates(encode_rates(rate_feed(events(spark, sf_dir))))


@query("parse_behavior_csv", f"""WITH {_BEHAVIOR}
  SELECT user_id, item_id, category_id, behavior, "timestamp" FROM behavior_feed""")
def _(spark, sf_dir):
    """Through the file reader: the feed is written as CSV to the shared folder and read back."""
    path = checkpoint_location(spark, f"behavior-csv-{uuid.uuid4().hex}")
    encode(behavior_feed(events(spark, sf_dir)), BEHAVIOR).write.text(path)
    return csv_records(spark, path)


# --- event time ------------------------------------------------------------------------------


@query("event_time_millis", """
  SELECT event_id, make_timestamp(epoch_us(ts) // 1000 * 1000) AS event_time FROM events""")
def _(spark, sf_dir):
    return events(spark, sf_dir).select(
        "event_id", naive(from_epoch_millis(epoch_millis("ts"))).alias("event_time")
    )


@query("event_time_seconds", "SELECT event_id, date_trunc('second', ts) AS event_time FROM events")
def _(spark, sf_dir):
    return behavior_feed(events(spark, sf_dir)).select(
        "event_id", naive(from_epoch_seconds("timestamp")).alias("event_time")
    )


def _late_sql(window_us: int, delay_us: int) -> str:
    return f"""
  WITH arrived AS (SELECT event_id, user_id, ts, event_id + (event_id * 7919) % 997 AS arrival FROM events),
  seen AS (SELECT *, max(ts) OVER (PARTITION BY user_id ORDER BY arrival, event_id
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS so_far FROM arrived)
  SELECT event_id, user_id, ts, make_timestamp((epoch_us(ts) // {window_us} + 1) * {window_us}) AS window_end,
         coalesce((epoch_us(ts) // {window_us} + 1) * {window_us} <= epoch_us(so_far) - {delay_us}, false) AS late
  FROM seen"""


def _late_rows(spark, sf_dir, window, delay):
    arrival = F.col("event_id") + (F.col("event_id") * 7919) % 997
    arrived = events(spark, sf_dir).select("event_id", "user_id", "ts", arrival.alias("arrival"))
    return mark_late(
        arrived, ["user_id"], "arrival", ["event_id"], "ts", window, delay
    ).select("event_id", "user_id", "ts", "window_end", "late")


@query("late_rows", _late_sql(3_600_000_000, 3_600_000_000))
def _(spark, sf_dir):
    return _late_rows(spark, sf_dir, "1 hour", "1 hour")


@query("late_rows_bounded", _late_sql(10_000_000, 1_000_000))
def _(spark, sf_dir):
    return _late_rows(spark, sf_dir, "10 seconds", "1 second")


@query("late_rows_ascending", _late_sql(10_000_000, 0))
def _(spark, sf_dir):
    return _late_rows(spark, sf_dir, "10 seconds", "0 seconds")


@query("late_rows_periodic", _late_sql(10_000_000, 3_500_000))
def _(spark, sf_dir):
    return _late_rows(spark, sf_dir, "10 seconds", "3500 milliseconds")


@query("late_rows_dropped", f"""SELECT event_id, user_id, ts, window_end
  FROM ({_late_sql(3_600_000_000, 3_600_000_000)}) WHERE NOT late""")
def _(spark, sf_dir):
    """What a windowed operator gets to see: rows whose window was still open when they came."""
    return _late_rows(spark, sf_dir, "1 hour", "1 hour").where(~F.col("late")).drop("late")


# --- filter, windows, aggregates -------------------------------------------------------------


@query("filter_pv", f"""WITH {_BEHAVIOR}
  SELECT event_id, user_id, item_id, category_id, behavior, "timestamp"
  FROM behavior_feed WHERE behavior = 'pv'""")
def _(spark, sf_dir):
    return page_views(behavior_feed(events(spark, sf_dir), "pv")).drop("ts")


@query("tumbling_count", f"""WITH {_ORDERS}
  SELECT currency, make_timestamp(us // 3600000000 * 3600000000) AS window_start,
         make_timestamp((us // 3600000000 + 1) * 3600000000) AS window_end, count(*) AS n
  FROM orders_feed GROUP BY 1, 2, 3""")
def _(spark, sf_dir):
    return tumbling_count(orders_feed(events(spark, sf_dir)), ["currency"], "ts", JOIN_WIDTH)


@query("sliding_count", f"WITH {_VIEWS} SELECT item_id, window_end, view_count FROM views")
def _(spark, sf_dir):
    return item_views(behavior_feed(events(spark, sf_dir), "pv"))


@query("sliding_sum", f"WITH {_SALES} SELECT item_id, window_end, allsum FROM sales")
def _(spark, sf_dir):
    ev = events(spark, sf_dir)
    return sales_sums(orders_feed(ev), rate_feed(ev), JOIN_WIDTH, SALES_SIZE, SALES_SLIDE)


_SESSIONS = """marked AS (
  SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 6 HOUR THEN 0 ELSE 1 END AS opens
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
numbered AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts
                                        RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid FROM marked)"""


@query("session_window_count", f"""WITH {_SESSIONS}
  SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 6 HOUR AS session_end, count(*) AS n
  FROM numbered GROUP BY user_id, sid""")
def _(spark, sf_dir):
    return session_count(events(spark, sf_dir), ["user_id"], "ts", SESSION_GAP)


# --- joins -----------------------------------------------------------------------------------


@query("tumbling_window_join", f"""WITH {_PAIRS}
  SELECT ts_ms, category, subcat, currency, amount, rate_ts_ms, rate_currency, rate, res FROM pairs""")
def _(spark, sf_dir):
    ev = events(spark, sf_dir)
    return converted_orders(orders_feed(ev), rate_feed(ev), JOIN_WIDTH).drop("ts")


_SELF_SESSIONS = f"""{_BEHAVIOR}, marked AS (
  SELECT event_id, user_id, item_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)
    <= INTERVAL 6 HOUR THEN 0 ELSE 1 END AS opens FROM behavior_feed WHERE user_id IS NOT NULL),
numbered AS (
  SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id
                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid FROM marked),
sessions AS (
  SELECT user_id, sid, min(ts) AS session_start, max(ts) + INTERVAL 6 HOUR AS session_end, count(*) AS n
  FROM numbered GROUP BY user_id, sid)"""


@query("session_window_join", f"""WITH {_SELF_SESSIONS}
  SELECT user_id, session_start, session_end, l.item_id AS left_item, l.ts AS left_ts,
         r.item_id AS right_item, r.ts AS right_ts, user_id || ' joined ' || user_id AS msg
  FROM numbered l JOIN numbered r USING (user_id, sid) JOIN sessions USING (user_id, sid)""")
def _(spark, sf_dir):
    behavior = behavior_feed(events(spark, sf_dir))
    return user_sessions(behavior, behavior, SESSION_GAP)


@query("session_self_join", f"""WITH {_BEHAVIOR}
  SELECT user_id, user_id || ' joined ' || user_id AS msg, count(*) AS n_left, count(*) AS n_right
  FROM behavior_feed WHERE user_id IS NOT NULL GROUP BY user_id""")
def _(spark, sf_dir):
    return user_self_join(behavior_feed(events(spark, sf_dir)))


_SESSION_COUNTS = f"""WITH {_SELF_SESSIONS}
  SELECT user_id, session_start, session_end, n AS n_left, n AS n_right,
         user_id || ' joined ' || user_id AS msg FROM sessions"""


@query("session_join_counts", _SESSION_COUNTS)
def _(spark, sf_dir):
    return user_session_counts(behavior_feed(events(spark, sf_dir)), SESSION_GAP)


# --- rankings --------------------------------------------------------------------------------


@query("hot_items_topn", f"WITH {_HOT} SELECT item_id, window_end, view_count, rk FROM hot")
def _(spark, sf_dir):
    return hot_items(behavior_feed(events(spark, sf_dir), "pv"))


@query("hot_items_report", f"WITH {_HOT} {_report('hot', 'view_count', '浏览量', '(rk - 1)')}")
def _(spark, sf_dir):
    return hot_items_report(hot_items(behavior_feed(events(spark, sf_dir), "pv")))


def _sales_ranking(spark, sf_dir, ascending):
    ev = events(spark, sf_dir)
    return sales_ranking(
        orders_feed(ev), rate_feed(ev), JOIN_WIDTH, SALES_SIZE, SALES_SLIDE, ascending=ascending
    )


@query("order_topn", f"WITH {_ranked_sales('DESC')} SELECT item_id, window_end, allsum, rk FROM ranked")
def order_topn(spark, sf_dir):
    return _sales_ranking(spark, sf_dir, ascending=False)


@query("order_bottomn", f"WITH {_ranked_sales('ASC')} SELECT item_id, window_end, allsum, rk FROM ranked")
def _(spark, sf_dir):
    return _sales_ranking(spark, sf_dir, ascending=True)


@query("order_report", f"WITH {_ranked_sales('ASC')} {_report('ranked', 'allsum', '销售额', 'rk')}")
def _(spark, sf_dir):
    return sales_report(_sales_ranking(spark, sf_dir, ascending=True))


# --- the same as streams ----------------------------------------------------------------------
#
# Each reads the whole table as a stream up to its end, which closes what is still open then: the
# results are those of the tables.


@query("stream_hot_items", f"WITH {_HOT} SELECT item_id, window_end, view_count, rk FROM hot")
def _(spark, sf_dir):
    behavior = behavior_feed(event_stream(configure_state_store(spark), sf_dir))
    result = catch_up(spark, "stream_hot_items", lambda run, path, until_end: ranked(
        streaming_hot_items.item_views(until_end(behavior)), run, rank_items, batch_files(path)))
    return result.select("item_id", naive("window_end").alias("window_end"), "view_count", "rk")


@query("stream_hot_items_timers", f"WITH {_HOT} SELECT item_id, window_end, view_count, rk FROM hot")
def _(spark, sf_dir):
    behavior = behavior_feed(event_stream(configure_state_store(spark), sf_dir))
    result = catch_up(spark, "stream_hot_items_timers", lambda run, path, until_end: to_files(
        streaming_hot_items.hot_items_by_timer(until_end(behavior)), run, path))
    return result.select("item_id", naive("window_end").alias("window_end"), "view_count", "rk")


@query("stream_hot_items_report", f"WITH {_HOT} {_report('hot', 'view_count', '浏览量', '(rk - 1)')}")
def _(spark, sf_dir):
    behavior = behavior_feed(event_stream(configure_state_store(spark), sf_dir))
    result = catch_up(spark, "stream_hot_items_report", lambda run, path, until_end: ranked(
        streaming_hot_items.item_views(until_end(behavior)), run,
        lambda views: hot_items_report(rank_items(views)), batch_files(path)))
    return result.select(naive("window_end").alias("window_end"), "report")


def _streamed_sales(spark, sf_dir, name, rank):
    ev = event_stream(configure_state_store(spark), sf_dir)
    return catch_up(spark, name, lambda run, path, until_end: ranked(
        streaming_conversion.sales_sums(
            until_end(orders_feed(ev)), until_end(rate_feed(ev)), JOIN_WIDTH, SALES_SIZE, SALES_SLIDE),
        run, rank, batch_files(path)))


@query("stream_order_topn", f"WITH {_ranked_sales('DESC')} SELECT item_id, window_end, allsum, rk FROM ranked")
def _(spark, sf_dir):
    result = _streamed_sales(spark, sf_dir, "stream_order_topn", rank_sales)
    return result.select("item_id", naive("window_end").alias("window_end"), "allsum", "rk")


@query("stream_order_report", f"WITH {_ranked_sales('ASC')} {_report('ranked', 'allsum', '销售额', 'rk')}")
def _(spark, sf_dir):
    result = _streamed_sales(spark, sf_dir, "stream_order_report",
                             lambda sums: sales_report(rank_sales(sums, ascending=True)))
    return result.select(naive("window_end").alias("window_end"), "report")


@query("stream_tumbling_join", f"""WITH {_PAIRS}
  SELECT ts_ms, category, subcat, currency, amount, rate_ts_ms, rate_currency, rate, res FROM pairs""")
def _(spark, sf_dir):
    """Files hold the lists that meet, which grow with the rows; their pairs, which grow with the square of a
    window's rows, are made as they are read."""
    ev = event_stream(configure_state_store(spark), sf_dir)
    with shuffles_dropped(spark):
        result = catch_up(spark, "stream_tumbling_join", lambda run, path, until_end: to_files(
            streaming_conversion.converted_orders(
                until_end(orders_feed(ev)), until_end(rate_feed(ev)), JOIN_WIDTH, paired=False).drop("w"),
            run, path).options(**REPEATED_LISTS))
    return streaming_conversion.pairs_of(result)


@query("stream_session_counts", _SESSION_COUNTS)
def _(spark, sf_dir):
    behavior = behavior_feed(event_stream(configure_state_store(spark), sf_dir))
    result = catch_up(spark, "stream_session_counts", lambda run, path, until_end: to_files(
        self_session_counts(ascending(until_end(behavior), "ts"), "user_id", "ts", SESSION_GAP), run, path))
    return result.select(
        "user_id", naive("session_start").alias("session_start"), naive("session_end").alias("session_end"),
        "n_left", "n_right", joined_message("user_id", "user_id").alias("msg"),
    )
