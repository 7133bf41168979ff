"""Windowed equi inner joins.

Every pair of a group is in the result, so a group's work is the product of its two sides, which
no partition size shows. The row joins therefore count both sides per group and lay a large group
out as a grid of cells: a left row goes to one row of cells, a right row to one column, and each
cell joins about ``CELL_ROWS`` by ``CELL_ROWS`` rows as a group of its own.

A row's place in the grid follows from what the row holds and nothing else. A task that is run again,
over rows in another order or in other partitions, therefore sends every row where it went before.
Copies of a row would all go to one place, so in large groups they are counted first and then dealt out in
lots of at most ``CELL_ROWS``, each with a number.

Neither input is force-broadcast: that is left to Catalyst and the sizes AQE measures. Nothing runs while
a join is being built: group sizes are part of its plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.durations import Duration, interval, positive_micros
from tidemark.functions.eventtime import as_time, pane_of, time_type
from tidemark.operators.large import LISTED_GROUPS, largest
from tidemark.operators.windows import session_panes

CELL_ROWS = 10_000


def _tagged(left: DataFrame, right: DataFrame, columns: list[str]) -> DataFrame:
    """Both sides' ``columns`` in one table, each row counting for its side; one scan if they are one table."""
    if left is right:
        both = left.select(*columns, F.lit(1).alias("n_left"), F.lit(1).alias("n_right"))
    else:
        both = left.select(*columns, F.lit(1).alias("n_left"), F.lit(0).alias("n_right")).unionByName(
            right.select(*columns, F.lit(0).alias("n_left"), F.lit(1).alias("n_right")))
    return both.where(" and ".join(f"`{c}` is not null" for c in columns))


def _cells(side: str, cell_rows: int) -> Column:
    return F.ceil(F.col(side) / cell_rows).alias(f"_{side}")


def _lots(df: DataFrame, columns: list[str], cell_rows: int) -> DataFrame:
    """Copies of a row as one row per ``cell_rows`` of them: ``_copies`` how many it stands for, ``_row``
    a number that follows from the row's content and the lot's number."""
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    lot = F.explode(F.sequence(F.lit(0), F.floor((F.col("_n") - 1) / cell_rows)))
    return counted.withColumn("_lot", lot).select(
        *columns, F.least(F.lit(cell_rows), F.col("_n") - F.col("_lot") * cell_rows).alias("_copies"),
        F.xxhash64(*columns, "_lot").alias("_row"))


def _copied(df: DataFrame, *counts: str) -> DataFrame:
    """Each row as often as the product of its counts says, one count after the other."""
    for count in counts:
        df = df.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col(count)))).drop("_copy", count)
    return df


def _join_cells(left: DataFrame, right: DataFrame, group: list[str]) -> DataFrame:
    """Join two sides that carry ``_row``, ``_copies`` and their group's cell counts ``_n_left``, ``_n_right``."""
    lhs = left.withColumn("_cell_row", F.pmod("_row", "_n_left")).withColumn(
        "_cell_column", F.explode(F.sequence(F.lit(0), F.col("_n_right") - 1)))
    rhs = right.withColumn("_cell_column", F.pmod("_row", "_n_right")).withColumn(
        "_cell_row", F.explode(F.sequence(F.lit(0), F.col("_n_left") - 1)))
    inner = ("_row", "_n_left", "_n_right")
    cell = [*group, "_cell_row", "_cell_column"]
    pairs = lhs.drop(*inner).withColumnRenamed("_copies", "_copies_left").join(
        rhs.drop(*inner).withColumnRenamed("_copies", "_copies_right"), cell, "inner")
    return _copied(pairs.drop("_cell_row", "_cell_column"), "_copies_left", "_copies_right")


def _join_groups(left: DataFrame, right: DataFrame, group: list[str], cell_rows: int, listed: int) -> DataFrame:
    """Inner join on ``group``, its large groups by cells.

    The large groups are found over the group columns alone, combined on the map side. Their list is
    broadcast; once it turns out to be empty, as it mostly does, AQE drops the part of the plan that
    deals with them, and what is left is a plain join that shuffles each row once.
    """
    sizes = (
        _tagged(left, right, group).groupBy(*group)
        .agg(F.sum("n_left").alias("n_left"), F.sum("n_right").alias("n_right"))
        .where("n_left > 0 and n_right > 0")
        .where((F.col("n_left") > cell_rows) | (F.col("n_right") > cell_rows))
    )
    large = largest(sizes, F.col("n_left") * F.col("n_right"), group, listed).select(
        *group, _cells("n_left", cell_rows), _cells("n_right", cell_rows))

    def with_cells(side: DataFrame) -> DataFrame:
        own = side.join(large, group, "left_semi")
        return _lots(own, side.columns, cell_rows).join(large, group)

    plain = left.join(large, group, "left_anti").join(right.join(large, group, "left_anti"), group)
    return plain.unionByName(_join_cells(with_cells(left), with_cells(right), group))


def tumbling_window_join(
    left: DataFrame, right: DataFrame, key: str, ts: str, width: Duration,
    cell_rows: int = CELL_ROWS, listed: int = LISTED_GROUPS,
) -> DataFrame:
    """Every (left, right) pair with an equal key in the same tumbling window.

    Gives ``key``, ``window_start``, ``window_end`` and both sides' other columns, of which no two
    may share a name; ``ts`` is the left side's, the right's is dropped.
    """
    kind, width_us = time_type(left, ts), positive_micros(width)
    lhs = left.withColumn("_window", pane_of(ts, width))
    rhs = right.withColumn("_window", pane_of(ts, width)).drop(ts)
    pairs = _join_groups(lhs, rhs, [key, "_window"], cell_rows, listed)
    return (
        pairs.withColumn("window_start", as_time(F.col("_window"), kind))
        .withColumn("window_end", as_time(F.col("_window") + width_us, kind))
        .drop("_window")
    )


def session_window_join(
    left: DataFrame, right: DataFrame, key: str, ts: str, gap: Duration,
    left_columns: dict[str, str], right_columns: dict[str, str], cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """Every (left, right) pair with an equal key in the same session, sessions being merged over
    the rows of both sides.

    ``left_columns`` / ``right_columns`` map output names to columns of each side. Both sides are one tagged
    table, read twice: for the sessions and their sizes, on pane summaries (see ``session_panes``), and
    for the rows, which get their session by pane. A session's two sides then meet as two lists, those
    of a large one as two lists per cell, so no list has many more than ``cell_rows`` rows; pairs are
    made list by list. If both sides are one table, its rows stand for both sides, also in the shuffles.
    """
    per_session = Window.partitionBy(key, "session_start")
    session = [key, "session_start", "session_end"]
    names = [*left_columns, *right_columns]
    sessions = (
        session_panes(
            _tagged(left, right, [key, ts]), [key], ts, gap,
            {"n_left": ("sum", "n_left"), "n_right": ("sum", "n_right")},
        )
        .select(
            key, "pane", "session_start",
            (F.max("last_ts").over(per_session) + interval(gap)).alias("session_end"),
            F.sum("n_left").over(per_session).alias("n_left"),
            F.sum("n_right").over(per_session).alias("n_right"),
        )
        .where("n_left > 0 and n_right > 0")
        .select(*session, "pane", _cells("n_left", cell_rows), _cells("n_right", cell_rows))
    )

    def payload(columns: dict[str, str]) -> Column:
        return F.struct(*(F.col(c).alias(n) for n, c in columns.items()))

    def tagged(side: DataFrame, as_left: bool, as_right: bool) -> DataFrame:
        nothing = F.lit(False)
        return side.select(
            F.col(key), pane_of(ts, gap).alias("pane"),
            (payload(left_columns) if as_left else F.when(nothing, empty_left)).alias("_left"),
            (payload(right_columns) if as_right else F.when(nothing, empty_right)).alias("_right"))

    def empty(side: DataFrame, columns: dict[str, str]) -> Column:
        return F.struct(*(F.lit(None).cast(side.schema[c].dataType).alias(n) for n, c in columns.items()))

    empty_left, empty_right = empty(left, left_columns), empty(right, right_columns)
    rows = tagged(left, True, True) if left is right else tagged(left, True, False).unionByName(
        tagged(right, False, True))
    placed = rows.join(sessions, [key, "pane"]).drop("pane")
    counts = ["_n_left", "_n_right"]

    def pairs_of(cells: DataFrame, group: list[str]) -> DataFrame:
        lists = cells.groupBy(*session, *group).agg(
            F.collect_list("_left").alias("_lefts"), F.collect_list("_right").alias("_rights"))
        return lists.withColumn("_l", F.explode("_lefts")).withColumn("_r", F.explode("_rights")).select(
            *session, "_l.*", "_r.*")

    small = pairs_of(placed.where("_n_left = 1 and _n_right = 1"), [])
    lots = _lots(placed.where("_n_left > 1 or _n_right > 1"), [*session, *counts, "_left", "_right"], cell_rows)
    by_row, by_column = F.pmod("_row", "_n_left"), F.pmod("_row", "_n_right")

    def of_side(side: str, cell_row: Column, cell_column: Column) -> DataFrame:
        return lots.where(F.col(side).isNotNull()).withColumn("_cell_row", cell_row).withColumn(
            "_cell_column", cell_column)

    across = F.explode(F.sequence(F.lit(0), F.col("_n_right") - 1))
    down = F.explode(F.sequence(F.lit(0), F.col("_n_left") - 1))
    copies = F.col("_copies")
    grid = of_side("_left", by_row, across).select(
        *session, "_cell_row", "_cell_column", F.struct("_left.*", copies.alias("_copies_left")).alias("_left"),
        F.when(F.lit(False), F.struct("_right.*", copies.alias("_copies_right"))).alias("_right"),
    ).unionByName(of_side("_right", down, by_column).select(
        *session, "_cell_row", "_cell_column",
        F.when(F.lit(False), F.struct("_left.*", copies.alias("_copies_left"))).alias("_left"),
        F.struct("_right.*", copies.alias("_copies_right")).alias("_right")))
    large = _copied(pairs_of(grid, ["_cell_row", "_cell_column"]), "_copies_left", "_copies_right")
    return small.unionByName(large.select(*session, *names))


def key_join_counts(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Equi inner join on the key alone, as a multiset: ``key, n_left, n_right``.

    Joined rows that carry nothing but the key are all alike within a key, so the two counts state
    the join in full: it holds each key's row ``n_left * n_right`` times. Both sides are counted
    on the map side in one aggregation, and no pair is made one by one. A self-join is read once.
    """
    if left is right:
        counts = left.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n_left"))
        return counts.withColumn("n_right", F.col("n_left"))
    return (
        _tagged(left, right, [key])
        .groupBy(key)
        .agg(F.sum("n_left").alias("n_left"), F.sum("n_right").alias("n_right"))
        .where("n_left > 0 and n_right > 0")
    )


def one_row_per_pair(counts: DataFrame) -> DataFrame:
    """Spell a multiset out: ``n_left * n_right`` copies of every other column. For small results
    that are to be printed line by line."""
    rest = [c for c in counts.columns if c not in ("n_left", "n_right")]
    per_left = counts.withColumn("_l", F.explode(F.sequence(F.lit(1), "n_left"))).repartition(*rest, "_l")
    return per_left.withColumn("_r", F.explode(F.sequence(F.lit(1), "n_right"))).select(*rest)
