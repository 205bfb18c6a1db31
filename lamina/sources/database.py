"""Snapshot and watermark pulls from a database through Spark's JDBC source."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.functions.literals import literal

TOKEN = re.compile(r"\{([A-Za-z0-9_.]+)\}")


def read_database(
    spark: SparkSession,
    url: str,
    *,
    table: str | None = None,
    query: str | None = None,
    partition_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    partitions: int | None = None,
    **options: str,
) -> DataFrame:
    """A table or query as a DataFrame.

    With ``partition_column`` executors read key ranges in parallel; filters applied to
    the result are pushed into the database by Spark.
    """
    if (table is None) == (query is None):
        raise ValueError("give either a table or a query")
    if query is not None and partition_column is not None:
        table, query = f"({query}) pulled", None
    reader = spark.read.format("jdbc").option("url", url).options(**options)
    reader = reader.option("dbtable", table) if table else reader.option("query", query)
    if partition_column is not None:
        low, high = bounds
        reader = reader.options(
            partitionColumn=partition_column, lowerBound=str(low), upperBound=str(high),
            numPartitions=str(partitions),
        )
    return reader.load()


def start_watermark(
    checkpoint: Mapping | None, key: str, default: object = None, static: bool = False
) -> object:
    """Where a delta pull starts: the checkpoint, else the default, else an error."""
    stored = None if static else (checkpoint or {}).get(key)
    value = stored if stored is not None else default
    if value is None:
        raise ValueError(f"no checkpoint and no default for watermark {key!r}")
    return value


def delta(df: DataFrame, column: str, after: object, filters: Sequence[str] = ()) -> DataFrame:
    """Rows strictly after the watermark that pass every filter."""
    out = df.filter(F.col(column) > literal(after, df.schema[column].dataType))
    for predicate in filters:
        out = out.filter(predicate)
    return out


def watermark_after(pulled: DataFrame, column: str, before: object) -> DataFrame:
    """One row: the largest non-null value pulled, else the value before."""
    dtype = pulled.schema[column].dataType
    return pulled.agg(
        F.coalesce(F.max(column), literal(before, dtype).cast(dtype)).alias("watermark")
    )


def fill(text: str, context: Mapping) -> str:
    """Replace ``{a.b}`` tokens; an unknown token is an error."""
    def value(match: re.Match) -> str:
        found: object = context
        for part in match.group(1).split("."):
            if not isinstance(found, Mapping) or part not in found:
                raise KeyError(f"unknown token {match.group(0)}")
            found = found[part]
        return str(found)

    return TOKEN.sub(value, text)
