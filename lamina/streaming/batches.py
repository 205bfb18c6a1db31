"""Bounded micro-batch runs with Structured Streaming.

A run processes everything available and stops; its position lives in the checkpoint
folder. Sinks are keyed by batch id, so a batch that is retried after a failure
replaces its own output instead of adding to it.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.operators.loads import latest_per_key, upsert_into

BATCH = "_batch_id"


def read_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    file_format: str = "parquet",
    max_files: int | None = None,
) -> DataFrame:
    """New files below ``path`` as a stream; files seen before are skipped."""
    reader = spark.readStream.format(file_format).schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def run_available(
    stream: DataFrame,
    sink: Callable[[DataFrame, int], None],
    checkpoint: str,
    output_mode: str = "append",
) -> list[dict]:
    """Process what is available, batch by batch, then stop; returns the progress of the last batches."""
    query = (
        stream.writeStream.foreachBatch(sink)
        .outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return [json.loads(progress.json) for progress in query.recentProgress]


def batch_table(path: str) -> Callable[[DataFrame, int], None]:
    """Sink that appends each batch as its own partition."""
    def write(df: DataFrame, batch_id: int) -> None:
        (
            df.withColumn(BATCH, F.lit(batch_id))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(BATCH)
            .parquet(path)
        )

    return write


def result_table(path: str) -> Callable[[DataFrame, int], None]:
    """Sink for complete mode: the newest result replaces the last one."""
    def write(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)

    return write


def upsert_table(
    path: str,
    schema: T.StructType,
    keys: Sequence[str],
    partition_columns: Sequence[str],
    newest_first: Sequence[str] = (),
) -> Callable[[DataFrame, int], None]:
    """Sink that upserts each batch by key; late rows land in their event-day partition.

    A key that comes several times in a batch counts once: its newest row by ``newest_first``
    (several such rows that differ otherwise are decided by their other columns). A batch that
    is replayed changes nothing.
    """
    rest = [c for c in schema.names if c not in keys and c not in newest_first]

    def write(df: DataFrame, batch_id: int) -> None:
        newest = latest_per_key(df, keys, [*newest_first, *rest] or keys)
        upsert_into(df.sparkSession, path, schema, newest, keys, partition_columns)

    return write


def windowed_counts(
    events: DataFrame, time: str, width: str, keys: Sequence[str], lateness: str | None = None
) -> DataFrame:
    """Counts per event-time window and key; ``lateness`` bounds the state kept."""
    if lateness is not None:
        # a watermark needs an instant; zone-less times count in the session's zone
        if isinstance(events.schema[time].dataType, T.TimestampNTZType):
            events = events.withColumn(time, F.col(time).cast("timestamp"))
        events = events.withWatermark(time, lateness)
    counted = events.groupBy(F.window(time, width), *keys).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.col("window.start").alias("window_start"), *keys, "n")
