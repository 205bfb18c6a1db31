"""Tolerant conversions used by the quality checks; null means "not convertible"."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMBER_TEXT = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"
ISO_TEXT = r"^\d{4}-\d{2}-\d{2}([T ].*)?$"
ZONE_SUFFIX = r":\d{2}(\.\d+)?\s*(Z|[+-]\d{2}(:?\d{2})?)$"
EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def as_number(column: Column, dtype: T.DataType) -> Column:
    """Numeric value as double; booleans count 0/1, blank text is null."""
    if isinstance(dtype, T.NumericType):
        return column.cast("double")
    if isinstance(dtype, T.BooleanType):
        return column.cast("int").cast("double")
    if isinstance(dtype, T.StringType):
        text = F.trim(column)
        return F.when(text.rlike(NUMBER_TEXT), text.try_cast("double"))
    return F.lit(None).cast("double")


def is_blank(column: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StringType):
        return column.isNull() | (F.trim(column) == "")
    return column.isNull()


def _ntz_micros(column: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", F.expr(EPOCH), column)


def as_epoch_micros(column: Column, dtype: T.DataType) -> Column:
    """Microseconds since the epoch; text without a zone, dates and zone-less timestamps are UTC."""
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(column)
    if isinstance(dtype, (T.TimestampNTZType, T.DateType)):
        return _ntz_micros(column.cast("timestamp_ntz"))
    if isinstance(dtype, T.NumericType):
        return (column.cast("double") * 1000000).try_cast("bigint")
    if isinstance(dtype, T.StringType):
        text = F.trim(column)
        zoned = F.unix_micros(text.try_cast("timestamp"))
        naive = _ntz_micros(text.try_cast("timestamp_ntz"))
        return F.when(
            text.rlike(ISO_TEXT), F.when(text.rlike(ZONE_SUFFIX), zoned).otherwise(naive)
        )
    return F.lit(None).cast("bigint")
