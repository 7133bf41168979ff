"""Balanced shards from a global prefix sum of byte sizes.

Documents are put in one order, the bytes before each follow from per-partition totals, and the
order is cut at equal byte targets: each shard is one contiguous run of the order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import running_totals, texts, written

LAW = "bytes"


def shard_documents(docs: DataFrame, shards: int = 8, whole_group_share: float = 0.05) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard (null) of every row of docs.

    The order is that of the doc_id, except that copies of a text stand directly after the first of
    them. A group of copies is put where its middle falls and so stays in one shard, unless it has
    more than ``whole_group_share`` of a shard's bytes: then it is cut like any other run, because
    sizes could not be equal otherwise.

    Null and empty texts have size 1 and are copies of each other. Null ids come first. Repeated
    rows each get a slot. Columns other than doc_id and text are ignored. An empty table gives an
    empty result.
    """
    text = F.coalesce("text", F.lit(""))
    narrow = written(
        texts(docs).select(
            "doc_id",
            (F.octet_length(text) + 1).cast("bigint").alias("size"),
            F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
            F.md5(F.encode(text, "UTF-8")).alias("digest"),
        ).withColumn("row", F.monotonically_increasing_id()),
        "shard-sizes",
    )
    groups = narrow.groupBy("digest").agg(
        F.min("doc_id").alias("first"), F.sum("size").alias("group_bytes"))
    placed = written(
        running_totals(
            narrow.join(groups, "digest"),
            ["first", "digest", "doc_id", "row"],
            {"before": F.col("size"), "rank": F.lit(1).cast("bigint")},
            "part",
            "shard-order",
        ),
        "shard-placed",
    )
    starts = placed.groupBy("digest").agg(F.min("before").alias("group_before"))
    whole = F.col("group_bytes") * shards <= F.col("before_all") * whole_group_share
    start = F.when(whole, F.col("group_before")).otherwise(F.col("before"))
    length = F.when(whole, F.col("group_bytes")).otherwise(F.col("size"))
    # The target that the middle falls into, in whole numbers.
    target = F.floor((start * 2 + length) * shards / (F.col("before_all") * 2)).cast("int")
    cut = written(
        placed.join(starts, "digest").select(
            "doc_id", "size", "text_crc32", "rank",
            F.least(target, F.lit(shards - 1)).alias("shard")),
        "shard-cut",
    )
    # One row per shard.
    first_ranks = cut.groupBy("shard").agg(F.min("rank").alias("shard_rank"))
    return cut.join(F.broadcast(first_ranks), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit(LAW).alias("law"),
        "shard",
        (F.col("rank") - F.col("shard_rank")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
