"""Results as plain columns: numbers as bigint or double, dates and times as text, lists joined by commas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def plain(column: Column, kind: T.DataType) -> Column:
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
        return column.cast("bigint")
    if isinstance(kind, T.ArrayType):
        return F.array_join(F.transform(column, lambda x: F.coalesce(x.cast("string"), F.lit(""))), ",")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(column, "yyyy-MM-dd HH:mm:ss")
    if isinstance(kind, T.DateType):
        return column.cast("string")
    return column


def flat(df: DataFrame, *columns: str) -> DataFrame:
    """The named columns (all without names) in plain types."""
    return df.select(*[plain(F.col(c), df.schema[c].dataType).alias(c) for c in (columns or df.columns)])
