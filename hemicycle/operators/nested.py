"""Structs and arrays to flat rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hemicycle.functions.keys import as_column


def flatten(df: DataFrame, *structs: str) -> DataFrame:
    """Put the fields of the structs beside the other columns, in place of the structs."""
    rest = [F.col(f"`{c}`") for c in df.columns if c not in structs]
    return df.select(*[f"{s}.*" for s in structs], *rest)


def unnest(df: DataFrame, col: str, alias: str) -> DataFrame:
    """One row per array element, in place of the array; rows with an empty or null array drop out.

    Compute what a whole row shares before this step: an expression in the same select as
    an explode is evaluated again for every element.
    """
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c != col], F.explode(col).alias(alias))


def as_list(col: Column | str) -> Column:
    """A scalar as a one-element array; a null gives an array with an empty text."""
    return F.array(F.coalesce(as_column(col).cast("string"), F.lit("")))


def or_empty(array: Column, element_type: str) -> Column:
    return F.coalesce(array, F.array().cast(f"array<{element_type}>"))
