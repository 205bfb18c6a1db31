"""Checkpoint history, replay lookup and backfill seeds as an append-only table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.functions.literals import literal
from lamina.operators.loads import latest_per_key

OWNER = ["environment", "source_name", "entity_name"]
HISTORY_SCHEMA = (
    "environment string, source_name string, entity_name string, run_id string,"
    " recorded_at timestamp_ntz, checkpoint_before string, checkpoint_after string,"
    " window_start timestamp_ntz, window_end timestamp_ntz, window_label string"
)


def window_label(start: datetime | None, end: datetime | None) -> str:
    if start is None and end is None:
        return "open"
    def text(d):
        return "open" if d is None else d.date().isoformat()

    return f"{text(start)}_to_{text(end)}"


def commit(
    spark: SparkSession,
    path: str,
    *,
    environment: str,
    source_name: str,
    entity_name: str,
    run_id: str,
    recorded_at: datetime,
    checkpoint_after: str | None,
    checkpoint_before: str | None = None,
    window_start: datetime | None = None,
    window_end: datetime | None = None,
) -> bool:
    """Append one history row, after the data is persisted; an unchanged state is not written."""
    if checkpoint_after is None or checkpoint_after == checkpoint_before:
        return False
    row = (environment, source_name, entity_name, run_id, recorded_at, checkpoint_before,
           checkpoint_after, window_start, window_end, window_label(window_start, window_end))
    spark.createDataFrame([row], HISTORY_SCHEMA).write.mode("append").parquet(path)
    return True


def read_history(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(HISTORY_SCHEMA).parquet(path)


def current(history: DataFrame) -> DataFrame:
    """Latest entry per source and entity."""
    return latest_per_key(history, OWNER, ["recorded_at", "run_id"])


def overlaps(
    start: Column, end: Column, low: datetime | None, high: datetime | None, dtype: T.DataType
) -> Column:
    """Inclusive interval overlap of columns of ``dtype``; a null bound on either side is open."""
    keep = F.lit(True)
    if low is not None:
        keep = keep & (end.isNull() | (end >= literal(low, dtype)))
    if high is not None:
        keep = keep & (start.isNull() | (start <= literal(high, dtype)))
    return keep


def replay_entries(
    history: DataFrame,
    run_id: str | None = None,
    window_start: datetime | None = None,
    window_end: datetime | None = None,
) -> DataFrame:
    dtype = history.schema["window_end"].dataType
    start, end = F.col("window_start"), F.col("window_end")
    out = history.filter(overlaps(start, end, window_start, window_end, dtype))
    return out.filter(F.col("run_id") == run_id) if run_id else out


def backfill_seed(history: DataFrame, window_start: datetime) -> DataFrame:
    """Per source and entity the entry whose window ends last, at or before ``window_start``."""
    if window_start is None:
        raise ValueError("a backfill needs a window start")
    limit = literal(window_start, history.schema["window_end"].dataType)
    eligible = history.filter(F.col("window_end") <= limit)
    return latest_per_key(eligible, OWNER, ["window_end", "recorded_at", "run_id"])


def rerun_selection(history: DataFrame, run_id: str) -> dict:
    """What an earlier run worked on, to run it again: owner and window."""
    row = history.filter(F.col("run_id") == run_id).select(
        *OWNER, "window_start", "window_end"
    ).first()
    if row is None:
        raise ValueError(f"no run {run_id!r} in the history")
    return row.asDict()


def select_manifests(
    manifests: DataFrame,
    window_start: datetime | None = None,
    window_end: datetime | None = None,
    **equal: str | None,
) -> DataFrame:
    """Landed artifacts whose window overlaps; without a window the ingest times count."""
    out = manifests
    for name, value in equal.items():
        if value is not None:
            out = out.filter(F.col(name) == value)
    start = F.coalesce("window_start", "ingest_started_at")
    end = F.coalesce("window_end", "ingest_completed_at")
    dtype = manifests.schema["ingest_completed_at"].dataType
    return out.filter(overlaps(start, end, window_start, window_end, dtype))
