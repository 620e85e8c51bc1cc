"""Display texts: links, truncation, placeholders, keyword match."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hemicycle.functions.keys import as_column


def html_link(url: Column | str, title: Column | str) -> Column:
    """Anchor that opens the bill page; a null part shows as ``None``."""
    return F.concat(
        F.lit('<a href="'),
        F.coalesce(as_column(url), F.lit("None")),
        F.lit('" target="_blank">'),
        F.coalesce(as_column(title), F.lit("None")),
        F.lit("</a>"),
    )


def truncated(col: Column | str, limit: int = 100) -> Column:
    c = as_column(col)
    return F.when(F.length(c) > limit, F.concat(F.left(c, F.lit(limit)), F.lit("..."))).otherwise(c)


def truncate_text(df: DataFrame, limit: int = 100) -> DataFrame:
    """Shorten every string column for display."""
    return df.select(
        *[
            truncated(F.col(f"`{f.name}`"), limit).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def year_or_dash(year: Column | str) -> Column:
    """A year as text, ``-`` while the term is open."""
    return F.coalesce(F.bround(as_column(year).cast("double"), 0).cast("bigint").cast("string"), F.lit("-"))


def matches(col: Column | str, term: str, regex: bool = False) -> Column:
    """Case-insensitive containment. Null text never matches; an empty term matches the rest.

    A plain term is taken literally. ``regex=True`` reads it as a pattern.
    """
    c = as_column(col)
    if regex:
        return c.rlike(f"(?i){term}")
    return F.contains(F.lower(c), F.lower(F.lit(term)))
