"""Field names made safe at every depth."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Characters replaced or dropped in field names.
REPLACED = {"-": "_"}
DROPPED = "@#:"


def clean_name(name: str) -> str:
    for old, new in REPLACED.items():
        name = name.replace(old, new)
    return "".join(ch for ch in name if ch not in DROPPED)


def clean_type(kind: T.DataType) -> T.DataType:
    if isinstance(kind, T.StructType):
        return T.StructType(
            [T.StructField(clean_name(f.name), clean_type(f.dataType), f.nullable) for f in kind.fields]
        )
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(clean_type(kind.elementType), kind.containsNull)
    if isinstance(kind, T.MapType):
        return T.MapType(kind.keyType, clean_type(kind.valueType), kind.valueContainsNull)
    return kind


def clean_names(df: DataFrame) -> DataFrame:
    """``-`` becomes ``_``; ``@ # :`` go. Nested names change by a cast, so no value is rebuilt by hand."""
    return df.select(
        *[F.col(f"`{f.name}`").cast(clean_type(f.dataType)).alias(clean_name(f.name)) for f in df.schema.fields]
    )
