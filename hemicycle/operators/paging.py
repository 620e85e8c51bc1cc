"""Sorted pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PAGE_SIZES = (25, 50, 100)


def page(df: DataFrame, order: Sequence[Column], number: int, size: int, compat: bool = False) -> DataFrame:
    """Page ``number`` (from 1) of the sorted rows.

    ``compat=True`` returns ``size + 1`` rows, so that a page repeats the first row of the
    next one. Sort, offset and limit run as one top-k: each task keeps ``number * size``
    rows at most. Use :func:`page_after` to walk far into a large result.
    """
    start = (number - 1) * size
    return df.orderBy(*order).offset(start).limit(size + 1 if compat else size)


def page_after(df: DataFrame, keys: Sequence[tuple[str, bool]], last: Sequence[object], size: int) -> DataFrame:
    """The ``size`` rows that follow the row with key values ``last``.

    ``keys`` lists ``(column, descending)``; together they must be unique and not null. The
    bound is a plain filter that reaches the scan, so page 1,000,000 costs as much as page 1.
    """
    after, tied = F.lit(False), F.lit(True)
    for (name, descending), value in zip(keys, last, strict=True):
        beyond = F.col(name) < F.lit(value) if descending else F.col(name) > F.lit(value)
        after = after | (tied & beyond)
        tied = tied & (F.col(name) == F.lit(value))
    order = [F.desc(name) if descending else F.asc(name) for name, descending in keys]
    return df.filter(after).orderBy(*order).limit(size)


def page_count(df: DataFrame, size: int, compat: bool = False) -> DataFrame:
    """One row ``(rows, pages)``; at least one page. ``compat=True`` loses a part page."""
    exact = F.col("rows") / F.lit(size)
    pages = F.floor(exact) if compat else F.ceil(exact)
    return df.agg(F.count("*").alias("rows")).select("rows", F.greatest(F.lit(1), pages).cast("bigint").alias("pages"))
