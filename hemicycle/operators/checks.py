"""Data-quality checks. Each returns the failing rows; an empty frame passes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with the count. A null part makes a key unchecked."""
    whole = df.dropna(subset=list(keys))
    return whole.groupBy(*keys).agg(F.count("*").alias("n_records")).filter(F.col("n_records") > 1)


def check_not_null(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNull())


def check_relationship(
    df: DataFrame, cols: str | Sequence[str], to: DataFrame, fields: str | Sequence[str]
) -> DataFrame:
    """Rows whose (non-null) reference has no match in ``to``."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    fields = [fields] if isinstance(fields, str) else list(fields)
    known = to.select(*[F.col(f).alias(f"__ref{i}") for i, f in enumerate(fields)]).distinct()
    same = [F.col(c) == F.col(f"__ref{i}") for i, c in enumerate(cols)]
    return df.dropna(subset=cols).join(known, same, "left_anti")
