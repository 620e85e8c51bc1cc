"""JSON columns, as text or parsed once into variants: scalars, arrays to rows.

A text is parsed by every function that looks into it; a variant never again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import VariantType

from hemicycle.functions.keys import as_column


def json_scalar(col: Column | str, path: str) -> Column:
    """Scalar at ``path`` as text; null for objects and arrays.

    Only text that opens like a container is parsed a second time to tell an object
    from a string that merely looks like one.
    """
    c = as_column(col)
    raw = F.get_json_object(c, path)
    kind = F.schema_of_variant(F.try_variant_get(F.try_parse_json(c), path, "variant"))
    looks_nested = F.left(raw, F.lit(1)).isin("{", "[")
    return F.when(looks_nested & F.coalesce(kind != "STRING", F.lit(True)), F.lit(None).cast("string")).otherwise(raw)


def json_array(col: Column | str, path: str) -> Column:
    """Array at ``path`` as an array of JSON texts; null if it is no array."""
    found = F.get_json_object(as_column(col), path)
    return F.when(F.left(found, F.lit(1)) == "[", F.from_json(found, "array<string>"))


def json_explode(df: DataFrame, col: str, path: str, alias: str) -> DataFrame:
    """One row per element of a JSON array; rows without elements drop out."""
    return df.withColumn(alias, F.explode(json_array(col, path)))


def json_list(col: Column | str, path: str, element: str) -> Column:
    """Array of structs at ``path``; one object counts as a list of one, as ``from_json`` takes it for an array of structs."""
    return F.from_json(F.get_json_object(as_column(col), path), f"array<{element}>")


def parse_parts(df: DataFrame, columns: list[str]) -> DataFrame:
    """The named JSON texts as variants; text that is no JSON becomes null. Write the result to parse it once."""
    return df.withColumns({c: F.try_parse_json(c) for c in columns if c in df.columns})


def is_variant(df: DataFrame, col: str) -> bool:
    return isinstance(df.schema[col].dataType, VariantType)


def variant_scalar(col: Column | str, path: str) -> Column:
    """:func:`json_scalar` of a variant."""
    v = as_column(col)
    kind = F.schema_of_variant(F.try_variant_get(v, path, "variant"))
    nested = kind.startswith("OBJECT") | kind.startswith("ARRAY")
    return F.when(~nested, F.try_variant_get(v, path, "string"))


def scalar_at(df: DataFrame, col: str, path: str) -> Column:
    """Scalar at ``path`` of a column that is a JSON text or a variant."""
    return variant_scalar(col, path) if is_variant(df, col) else json_scalar(col, path)


def array_at(df: DataFrame, col: str, path: str) -> Column:
    """Array at ``path`` with elements of the column's own kind, texts or variants; null if it is no array."""
    return F.try_variant_get(col, path, "array<variant>") if is_variant(df, col) else json_array(col, path)


def list_at(df: DataFrame, col: str, path: str, element: str) -> Column:
    """Array of structs at ``path`` of a JSON text or a variant; one object counts as a list of one."""
    if not is_variant(df, col):
        return json_list(col, path, element)
    one = F.try_variant_get(col, path, element)
    return F.coalesce(F.try_variant_get(col, path, f"array<{element}>"), F.when(one.isNotNull(), F.array(one)))
