"""Latest row per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_per_group(
    df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column], k: int = 1
) -> DataFrame:
    """The first ``k`` rows of each group in the given order.

    Spark plans the rank filter as a group limit on both sides of the exchange, so a
    map task sends at most ``k`` rows of a group however large the group is. Give an
    order that has no ties, or the pick among equals is arbitrary.
    """
    rank = "__rank"
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= k).drop(rank)


def open_end_last(end: str, open_value: int = 9999) -> Column:
    """Sort key that puts an open (null) end before every closed one."""
    return F.coalesce(F.col(end), F.lit(open_value)).desc()
