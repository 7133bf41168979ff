"""Connected components of a distributed graph, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written


# Edges that a file may hold before there are more of them.
FILE_ROWS = 100_000


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_003)).first())


def components(links: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """node and component (its smallest member) of every node that a link (a, b) touches. ``rows``: how many
    links there are at most, if that is known; the first table then takes no more files than they need.

    Each round hangs every node's neighbours on its smallest one, first the larger ones, then the
    smaller ones; only minima per node are gathered, so a node with very many neighbours is one
    aggregate and a splittable join. Rounds are about the logarithm of the longest path. Edges are
    written each round, which cuts the lineage; they only get fewer, so a round's files follow from the
    number of edges before it and not from the shuffle's partitions.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = written(edges if rows is None else edges.coalesce(1 + rows // FILE_ROWS), f"{name}-links")
    mark = _mark(edges)
    while mark[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = both.join(least, "u").where("v > u").select(
            F.col("v").alias("u"), F.least("u", "m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = small.union(least.select("u", F.col("m").alias("v"))).distinct()
        edges = written(stars.coalesce(1 + mark[0] // FILE_ROWS), f"{name}-stars")
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    # Every edge now leads from a node to its component's smallest one.
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select("v", "v").distinct())
