"""Row width expressions for size checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bytes of one non-text value in memory.
_WIDTHS = {
    "boolean": 1,
    "byte": 1,
    "short": 2,
    "integer": 4,
    "float": 4,
    "date": 4,
    "long": 8,
    "double": 8,
    "timestamp": 8,
    "timestamp_ntz": 8,
}


def _width(field: T.StructField) -> Column:
    kind = field.dataType
    col = F.col(f"`{field.name}`")
    if isinstance(kind, T.StringType):
        return F.coalesce(F.octet_length(col), F.lit(0)) + 8
    if isinstance(kind, T.BinaryType):
        return F.coalesce(F.length(col), F.lit(0)) + 8
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return F.coalesce(F.octet_length(F.to_json(F.struct(col))), F.lit(0)) + 16
    return F.lit(_WIDTHS.get(kind.typeName(), 16))


def row_bytes(df: DataFrame) -> Column:
    """Approximate in-memory bytes of one row of ``df``."""
    return reduce(lambda a, b: a + b, (_width(f) for f in df.schema.fields), F.lit(16)).cast("bigint")
