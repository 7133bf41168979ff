"""The few largest groups of a table, so that only they pay for being cut up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# So many groups at most are cut up. Which ones decides where rows are joined, never which.
LISTED_GROUPS = 10_000


def largest(groups: DataFrame, by: Column, keys: list[str], listed: int = LISTED_GROUPS) -> DataFrame:
    """The first ``listed`` of ``groups`` by ``by``, largest first, to be joined to as a broadcast table.

    It is part of the plan of the query that uses it: nothing runs before that. The limit bounds
    what is broadcast, whatever the data; groups beyond it are left whole, and there are then so
    many of them that they keep all tasks busy as they are.
    """
    return F.broadcast(groups.orderBy(by.desc(), *keys).limit(listed))
