"""Optional and scoped filters, option counts."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hemicycle.functions.text import matches

# Sessions the dashboard offers; the number is the first three characters.
SESSION_LABELS = ("118th Congress (2023-2025)", "119th Congress (2025-2027)")
SESSIONS = tuple(int(label[:3]) for label in SESSION_LABELS)


def session_number(label: str) -> int:
    return int(label[:3])


def scope_session(
    df: DataFrame, session: int | str | None = None, sessions: Sequence[int] = SESSIONS, col: str = "congress"
) -> DataFrame:
    """One session, or all offered ones if none is chosen. Prunes folders of a table partitioned by it."""
    if session is None:
        return df.filter(F.col(col).isin(*sessions))
    return df.filter(F.col(col) == (session_number(session) if isinstance(session, str) else session))


def search_text(df: DataFrame, col: str, term: str, regex: bool = False) -> DataFrame:
    return df.filter(matches(col, term, regex))


def where_all(df: DataFrame, conditions: Iterable[Column | None]) -> DataFrame:
    """Filter by the conditions that are given; ``None`` stands for no choice."""
    chosen = [c for c in conditions if c is not None]
    return df.filter(reduce(lambda a, b: a & b, chosen)) if chosen else df


def policy_area_counts(
    df: DataFrame, member: str | None, member_col: str = "bioguideID", area: str = "policyArea"
) -> DataFrame:
    """Rows per policy area of a member (of everyone, by member, if none is given), with option label."""
    keys = [area] if member is not None else [member_col, area]
    scoped = where_all(df, [F.col(member_col) == member if member is not None else None, F.col(area).isNotNull()])
    counted = scoped.groupBy(*keys).agg(F.count("*").alias("n"))
    label = F.concat(F.col(area), F.lit(" | (n="), F.col("n").cast("string"), F.lit(")"))
    labelled = counted.withColumn("label", label)
    # The list of one member is shown in order; a table of all members is not.
    return labelled.orderBy(*keys) if member is not None else labelled
