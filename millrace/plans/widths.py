"""Sizes of rows, measured by expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _width(field: T.StructField) -> Column:
    kind, col = field.dataType, F.col(f"`{field.name}`")
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(col), F.lit(0)) + 16
    if isinstance(kind, T.ArrayType):
        if isinstance(kind.elementType, (T.NumericType, T.BooleanType)):
            return F.coalesce(F.size(col), F.lit(0)) * 8 + 24
        return F.coalesce(F.octet_length(F.to_json(col)), F.lit(0)) * 2 + 24
    if isinstance(kind, (T.MapType, T.StructType)):
        return F.coalesce(F.octet_length(F.to_json(col)), F.lit(0)) * 2 + 24
    return F.lit(8)


def row_width(df: DataFrame) -> Column:
    """About the bytes of a row of ``df`` in memory."""
    width = F.lit(16)
    for field in df.schema.fields:
        width = width + _width(field)
    return width.cast("long")
