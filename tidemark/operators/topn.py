"""Top-N per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_GROUP_LIMIT_SETTING = "spark.sql.optimizer.windowGroupLimitThreshold"


def _order(measure: str, ties: list[str], ascending: bool) -> list[Column]:
    first = F.col(measure).asc() if ascending else F.col(measure).desc()
    return [first, *(F.col(t).asc() for t in ties)]


def top_n(
    df: DataFrame, by: list[str], measure: str, n: int, ties: list[str],
    ascending: bool = False, rank: str = "rk", buckets: int = 256,
) -> DataFrame:
    """The first ``n`` rows of each group by ``measure``, largest first unless ``ascending``.

    ``ties`` order equal measures, so the result is the same on every run; a group with fewer
    rows gives what it has. Catalyst cuts each map task's output to ``n`` rows per group
    before the shuffle (WindowGroupLimit); for an ``n`` above its threshold the same cut is
    made here, in hash buckets of the group.
    """
    order = _order(measure, ties, ascending)
    if n > int(df.sparkSession.conf.get(_GROUP_LIMIT_SETTING)):
        bucket = F.pmod(F.xxhash64(*ties), F.lit(buckets))
        per_bucket = Window.partitionBy(*by, "_bucket").orderBy(*order)
        df = (
            df.withColumn("_bucket", bucket)
            .withColumn("_bucket_rank", F.row_number().over(per_bucket))
            .where(F.col("_bucket_rank") <= n)
            .drop("_bucket", "_bucket_rank")
        )
    per_group = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(per_group)).where(F.col(rank) <= n)
