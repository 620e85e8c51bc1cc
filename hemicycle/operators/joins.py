"""Join shapes that need care with nulls, size or fan-out.

No side carries a broadcast hint. Spark broadcasts a side when its size, estimated from
the files or measured by the adaptive stage before the join, is under
``spark.sql.autoBroadcastJoinThreshold``; beyond it the sort-merge join takes over and the
adaptive planner splits hot partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def in_values(df: DataFrame, col: str, values: DataFrame) -> DataFrame:
    """``col IN (values)``: rows whose value occurs in the one-column frame."""
    ids = values.select(F.col(values.columns[0]).alias("__id")).distinct()
    return df.join(ids, F.col(col) == F.col("__id"), "left_semi")


def not_in_values(df: DataFrame, col: str, values: DataFrame) -> DataFrame:
    """``col NOT IN (values)`` with SQL null rules, at any size of the list.

    Spark runs a literal ``NOT IN`` by broadcasting the list whatever its size. Here the
    anti join is an ordinary one, and the null rules come from a one-row summary: a null
    in the list rejects every row, a null value is kept only if the list is empty.
    """
    ids = values.select(F.col(values.columns[0]).alias("__id")).distinct()
    summary = ids.agg(F.count("*").alias("n"), F.count("__id").alias("known"))
    has_null = summary.select(F.col("n") > F.col("known")).scalar()
    is_empty = summary.select(F.col("n") == 0).scalar()
    kept = df.join(ids, F.col(col) == F.col("__id"), "left_anti")
    return kept.filter(is_empty | (F.col(col).isNotNull() & ~has_null))


def in_either(df: DataFrame, tests: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """Rows for which at least one ``(column, values)`` membership holds.

    Every list is made distinct and marked, so the outer joins never multiply rows.
    """
    out, marks = df, []
    for n, (col, values) in enumerate(tests):
        key, mark = f"__k{n}", f"__m{n}"
        ids = values.select(F.col(values.columns[0]).alias(key)).filter(F.col(key).isNotNull()).distinct()
        out = out.join(ids.withColumn(mark, F.lit(True)), F.col(col) == F.col(key), "left")
        marks.append(mark)
    hit = F.coalesce(*[F.col(m) for m in marks], F.lit(False))
    return out.filter(hit).select(*df.columns)


def override(df: DataFrame, overrides: DataFrame, key: str, col: str) -> DataFrame:
    """Replace ``col`` by the override table's value where it has one."""
    patch = overrides.select(F.col(key).alias("__key"), F.col(col).alias("__value"))
    joined = df.join(patch, F.col(key) == F.col("__key"), "left")
    return joined.withColumn(col, F.coalesce("__value", col)).drop("__key", "__value")


def attach_totals(detail: DataFrame, totals: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each distinct row of ``detail`` with the totals of its key; rows with a null key drop out.

    ``totals`` is an aggregate of the same rows, unique on the key, so making the detail
    distinct before the join gives the same rows as after it, from a smaller join.
    """
    return detail.distinct().join(totals, list(keys), "inner")
