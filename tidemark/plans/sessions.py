"""Rows of one user joined within a session."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.durations import Duration
from tidemark.operators.joins import key_join_counts, session_window_join
from tidemark.operators.windows import session_count

# Fixed value: inactivity that ends a session.
SESSION_GAP = "10 minutes"


def joined_message(left: str, right: str) -> Column:
    return F.concat(F.col(left).cast("string"), F.lit(" joined "), F.col(right).cast("string"))


def user_sessions(left: DataFrame, right: DataFrame, gap: Duration = SESSION_GAP, ts: str = "ts") -> DataFrame:
    """``user_id, session_start, session_end, left_item, right_item, left_ts, right_ts, msg`` for every
    pair of a left and a right row in one session of a user."""
    return session_window_join(
        left, right, "user_id", ts, gap,
        {"left_item": "item_id", "left_ts": ts}, {"right_item": "item_id", "right_ts": ts},
    ).withColumn("msg", joined_message("user_id", "user_id"))


def user_self_join(behavior: DataFrame) -> DataFrame:
    """``user_id, msg, n_left, n_right``: the self-join by user when rows carry no event time, so that
    all of a user's rows share one session. The line ``msg`` comes n_left * n_right times."""
    return key_join_counts(behavior, behavior, "user_id").select(
        "user_id", joined_message("user_id", "user_id").alias("msg"), "n_left", "n_right"
    )


def user_session_counts(behavior: DataFrame, gap: Duration = SESSION_GAP, ts: str = "ts") -> DataFrame:
    """``user_id, session_start, session_end, n_left, n_right, msg``: the session join of the whole feed
    with itself. Its rows carry nothing but the line ``msg``, n_left * n_right times per session, so
    the two counts state it in full."""
    return session_count(behavior.where(F.col("user_id").isNotNull()), ["user_id"], ts, gap, "n_left").select(
        "user_id", "session_start", "session_end", "n_left", F.col("n_left").alias("n_right"),
        joined_message("user_id", "user_id").alias("msg"))
