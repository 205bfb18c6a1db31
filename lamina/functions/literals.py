"""Literals for points in time that do not depend on the session's time zone."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def literal(value: object, dtype: T.DataType) -> Column:
    """``value`` as a literal to compare with a column of ``dtype``; naive datetimes are UTC."""
    if not isinstance(value, datetime):
        return F.lit(value)
    utc = value if value.tzinfo is None else value.astimezone(timezone.utc).replace(tzinfo=None)
    if isinstance(dtype, T.TimestampNTZType):
        return F.lit(utc.isoformat(sep=" ")).cast("timestamp_ntz")
    if isinstance(dtype, T.TimestampType):
        return F.lit(utc.isoformat(sep=" ") + "Z").cast("timestamp")
    if isinstance(dtype, T.DateType):
        return F.lit(utc.date())
    return F.lit(value)
