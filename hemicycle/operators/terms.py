"""Spans of service: condensed by chamber, or split into unbroken runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN_YEAR = 9999


def _span(start: str, end: str) -> list[Column]:
    last = F.max(F.coalesce(F.col(end), F.lit(OPEN_YEAR)))
    return [F.min(start).alias(start), F.nullif(last, F.lit(OPEN_YEAR)).alias(end)]


def terms_condensed(
    terms: DataFrame,
    member: str = "bioguideID",
    chamber: str = "chamber",
    start: str = "term_start_year",
    end: str = "term_end_year",
) -> DataFrame:
    """First start and last end per member and chamber; any open term leaves the end open.

    Gaps are bridged: someone who left and came back has one row.
    """
    return terms.groupBy(member, chamber).agg(*_span(start, end))


def term_islands(
    terms: DataFrame,
    member: str = "bioguideID",
    chamber: str = "chamber",
    start: str = "term_start_year",
    end: str = "term_end_year",
) -> DataFrame:
    """Like :func:`terms_condensed`, with one row per unbroken run of terms.

    A term continues a run if it starts in the year the member's previous term ended, in
    the same chamber. The open term sorts first. Both windows share one exchange on the
    member. Input is one row per (member, start, chamber), as the term dimension
    guarantees, so a group is bounded by calendar years times chambers, not by data volume.
    """
    by_member = Window.partitionBy(member).orderBy(
        F.asc_nulls_first(end), F.asc_nulls_first(chamber), F.asc_nulls_first(start)
    )
    by_run = Window.partitionBy(member, chamber).orderBy(F.asc_nulls_first(end))
    continues = (F.col(start) == F.lag(end).over(by_member)) & (F.col(chamber) == F.lag(chamber).over(by_member))
    flagged = terms.withColumn("__new", F.when(continues, 0).otherwise(1))
    numbered = flagged.withColumn("term_group", F.sum("__new").over(by_run))
    return numbered.groupBy(member, chamber, "term_group").agg(*_span(start, end))
