"""Pages of a stored order: page n is read from the one or two ranges that hold it.

The rows are written once in ranges of the order, with the number of rows before each range beside them.
A page then costs some pages of the files of its ranges whatever its number, where a top-k keeps
``number * size`` rows in every task. The order is cut by sampled values, so no range and no task holds more than its share.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows that a range should hold.
RANGE_ROWS = 100_000
#: Ranges at most. Each is a task, a folder and a row in the driver; beyond it ranges hold more rows.
MAX_RANGES = 1024
_RANGE, _PLACE = "__range", "__place"
#: The bits of an increasing id that number the rows of a task.
_IN_TASK = (1 << 33) - 1


def build_pages(rows: DataFrame, order: Sequence[Column], path: str, range_rows: int = RANGE_ROWS) -> None:
    """Writes ``rows`` in ranges of ``order``, replacing an older table.

    The order must leave no ties among unlike rows, or the pages of equal rows are arbitrary.
    """
    ranges = min(max(1, -(-rows.count() // range_rows)), MAX_RANGES)
    dealt = rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order).withColumns(
        {_PLACE: F.monotonically_increasing_id().bitwiseAND(F.lit(_IN_TASK)), _RANGE: F.spark_partition_id()}
    )
    # Each task has one range, so partitionBy opens one file and keeps the order.
    dealt.write.mode("overwrite").partitionBy(_RANGE).parquet(f"{path}/rows")
    rows.limit(0).write.mode("overwrite").parquet(f"{path}/columns")
    stored = rows.sparkSession.read.schema(f"{_RANGE} int").parquet(f"{path}/rows")
    stored.groupBy(_RANGE).agg(F.count("*").alias("n")).coalesce(1).write.mode("overwrite").parquet(f"{path}/ranges")


def ranges_of(spark: SparkSession, path: str) -> list[tuple[int, int, int]]:
    """Range, place of its first row and of the first one after it, in order; ``MAX_RANGES`` at most."""
    found, place = [], 0
    for number, n in sorted(map(tuple, spark.read.parquet(f"{path}/ranges").select(_RANGE, "n").collect())):
        found.append((number, place, place + n))
        place += n
    return found


def read_page(spark: SparkSession, path: str, order: Sequence[Column], number: int, size: int, compat: bool = False) -> DataFrame:
    """:func:`hemicycle.operators.paging.page` of the rows written by :func:`build_pages` with the same order."""
    first = (number - 1) * size
    last = first + size + (1 if compat else 0)
    held = [(r, begin) for r, begin, end in ranges_of(spark, path) if begin < last and end > first]
    if not held:
        return spark.read.parquet(f"{path}/columns")
    # Folders by range; within a file the places, which lie in order, tell which of its pages to read.
    near = spark.read.parquet(f"{path}/rows").filter(F.col(_RANGE).isin([r for r, _ in held]))
    within = [(F.col(_RANGE) == r) & F.col(_PLACE).between(first - begin, last - begin - 1) for r, begin in held]
    return near.filter(reduce(lambda a, b: a | b, within)).drop(_RANGE, _PLACE).orderBy(*order)


def page_count(spark: SparkSession, path: str, size: int) -> int:
    """Number of pages, at least one; no row is read."""
    total = max((end for _, _, end in ranges_of(spark, path)), default=0)
    return max(1, -(-total // size))
