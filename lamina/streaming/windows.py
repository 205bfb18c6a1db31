"""Event-time windows whose state expires, with late rows kept in a side table.

A watermark trails the newest event time by ``lateness``. Windows and sessions that end at or before
it are final: append mode emits them once and drops their state, so state holds what the last
``lateness`` of event time left open, whatever the stream has seen. Rows behind the watermark would
be dropped without a trace; ``route_late_rows`` puts them aside first, by the same rule.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina import storage
from lamina.operators.loads import read_table
from lamina.streaming.batches import BATCH, read_files

LATE = "_late"


def instants(events: DataFrame, time: str) -> DataFrame:
    """``events`` with ``time`` as instants: zone-less times count in the session's zone."""
    if isinstance(events.schema[time].dataType, T.TimestampNTZType):
        return events.withColumn(time, F.col(time).cast("timestamp"))
    return events


def closing_counts(events: DataFrame, time: str, width: str, keys: Sequence[str], lateness: str) -> DataFrame:
    """Counts per event-time window and key, each emitted once when its window has closed."""
    events = instants(events, time).withWatermark(time, lateness)
    counted = events.groupBy(F.window(time, width), *keys).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.col("window.start").alias("window_start"), *keys, "n")


def closing_sessions(events: DataFrame, time: str, gap: str, keys: Sequence[str], lateness: str) -> DataFrame:
    """Sessions per key (events less than ``gap`` apart), each emitted once when it has closed.

    ``session_end`` is ``gap`` after the last event.
    """
    events = instants(events, time).withWatermark(time, lateness)
    counted = events.groupBy(F.session_window(time, gap), *keys).agg(F.count(F.lit(1)).alias("n"))
    start, end = F.col("session_window.start"), F.col("session_window.end")
    return counted.select(start.alias("session_start"), end.alias("session_end"), *keys, "n")


def first_occurrences(events: DataFrame, keys: Sequence[str], time: str, lateness: str) -> DataFrame:
    """The first row of each key; its state lasts until the watermark passes the row's time."""
    return instants(events, time).withWatermark(time, lateness).dropDuplicatesWithinWatermark(list(keys))


def open_windows(spark: SparkSession, checkpoint: str, keys: Sequence[str]) -> DataFrame:
    """Counts of ``closing_counts`` that are still open, read from the state the last run left."""
    state = spark.read.format("statestore").load(checkpoint)
    fields = [f.name for f in state.schema["value"].dataType.fields]
    if len(fields) != 1:
        raise ValueError("the state is not that of windowed counts")
    window = state.schema["key"].dataType.fields[0].name
    names = [F.col(f"key.{c}").alias(c) for c in keys]
    start = F.col(f"key.`{window}`.start").alias("window_start")
    return state.select(start, *names, F.col(f"value.`{fields[0]}`").alias("n"))


def route_late_rows(path: str, time: str, lateness: str) -> Callable[[DataFrame, int], None]:
    """Sink that keeps rows behind the watermark apart from the others.

    The watermark of a batch is the newest time of all earlier batches less ``lateness``; rows without a
    time are late. Rows go to ``path/rows`` by whether they are late and by batch, the newest time to
    ``path/marks``. A batch that is replayed replaces its own rows and finds the same watermark.
    """
    marks_schema = f"newest timestamp, {BATCH} bigint"

    def write(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        df = instants(df, time)
        newest = None
        if storage.exists(spark, f"{path}/marks"):
            earlier = spark.read.schema(marks_schema).parquet(f"{path}/marks").where(F.col(BATCH) < batch_id)
            newest = earlier.agg(F.max("newest")).first()[0]
        late = F.col(time).isNull()
        if newest is not None:
            late = late | (F.col(time) < F.lit(newest) - F.expr(f"INTERVAL {lateness}"))
        seen = Observation()
        rows = df.withColumns({LATE: late, BATCH: F.lit(batch_id)}).observe(seen, F.max(time).alias("newest"))
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(LATE, BATCH).parquet(f"{path}/rows")
        last = seen.get["newest"]
        newest = max((t for t in (newest, last) if t is not None), default=None)
        mark = spark.createDataFrame([(newest, batch_id)], marks_schema).coalesce(1)
        writer = mark.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(BATCH).parquet(f"{path}/marks")

    return write


def _rows_schema(schema: T.StructType, time: str) -> T.StructType:
    stored = [T.StructField(f.name, T.TimestampType()) if f.name == time else f for f in schema.fields]
    return T.StructType(stored)


def punctual_rows(
    spark: SparkSession, path: str, schema: T.StructType, time: str, max_files: int | None = None
) -> DataFrame:
    """Stream of the rows that ``route_late_rows`` let pass; to be run when the routing run has ended.

    A watermark of the same lateness drops none of them.
    """
    return read_files(spark, f"{path}/rows/{LATE}=false", _rows_schema(schema, time), max_files=max_files)


def late_rows(spark: SparkSession, path: str, schema: T.StructType, time: str) -> DataFrame:
    """The side table: all rows that came behind the watermark, with their batch."""
    stored = T.StructType([*_rows_schema(schema, time).fields, T.StructField(LATE, T.BooleanType()), T.StructField(BATCH, T.LongType())])
    return read_table(spark, f"{path}/rows", stored).where(F.col(LATE)).drop(LATE)
