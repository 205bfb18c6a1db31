"""Ingest runs: pull, persist, then commit the checkpoint."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina import storage
from lamina.operators import state
from lamina.sources import database, eventlog

EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


@dataclass(frozen=True)
class IngestRun:
    run_id: str
    path: str | None  # None when nothing new arrived
    rows: int
    checkpoint: dict


def _text(value: object) -> object:
    return value.isoformat() if isinstance(value, (datetime, date)) else value


def _typed(value: object, dtype: T.DataType) -> object:
    if isinstance(value, str) and isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return datetime.fromisoformat(value)
    if isinstance(value, str) and isinstance(dtype, T.DateType):
        return date.fromisoformat(value)
    return value


def load_checkpoint(spark, state_path: str, owner: dict) -> dict:
    """Latest committed state of one source and entity; empty before the first commit."""
    if not storage.has_files(spark, state_path):
        return {}
    history = state.read_history(spark, state_path)
    for name, value in owner.items():
        history = history.filter(F.col(name) == value)
    row = state.current(history).select("checkpoint_after").first()
    return json.loads(row[0]) if row else {}


def _commit(spark, state_path, owner, run_id, recorded_at, before, after) -> None:
    state.commit(
        spark, state_path, **owner, run_id=run_id, recorded_at=recorded_at,
        checkpoint_before=json.dumps(before, sort_keys=True) if before else None,
        checkpoint_after=json.dumps(after, sort_keys=True),
    )


def run_watermark_delta(
    source: DataFrame,
    column: str,
    *,
    root: str,
    state_path: str,
    owner: dict,
    run_id: str,
    recorded_at: datetime,
    default: object = None,
    filters: Sequence[str] = (),
) -> IngestRun:
    """Rows after the stored watermark, landed once; the new watermark is committed last.

    Rows, row count and the new watermark come from one job.
    """
    spark, dtype = source.sparkSession, source.schema[column].dataType
    before = load_checkpoint(spark, state_path, owner)
    start = _typed(database.start_watermark(before, column, _text(default)), dtype)
    pulled = database.delta(source, column, start, filters)
    seen, path = Observation(), f"{root}/run_id={run_id}"
    instant = isinstance(dtype, T.TimestampType)
    newest = F.max(F.unix_micros(column)) if instant else F.max(column).cast("string")
    pulled.observe(
        seen, F.count(F.lit(1)).alias("rows"), newest.alias("newest")
    ).write.mode("errorifexists").parquet(path)
    rows, found = seen.get["rows"], seen.get["newest"]
    if instant and found is not None:
        found = (EPOCH + timedelta(microseconds=found)).isoformat()
    after = {**before, column: found} if found is not None else before
    if after != before:
        _commit(spark, state_path, owner, run_id, recorded_at, before, after)
    return IngestRun(run_id, path if rows else None, int(rows), after)


def run_log_batch(
    log: DataFrame,
    *,
    root: str,
    state_path: str,
    owner: dict,
    run_id: str,
    recorded_at: datetime,
    max_messages: int,
) -> IngestRun:
    """The next messages of every topic partition, landed once, then the offsets committed.

    The checkpoint holds one offset per topic partition.
    """
    spark = log.sparkSession
    before = load_checkpoint(spark, state_path, owner)
    known = [(t, int(p), n) for t, parts in before.items() for p, n in parts.items()]
    starts = spark.createDataFrame(known, "topic string, partition int, start_offset bigint")
    batch = eventlog.first_messages(eventlog.from_offsets(log, starts), max_messages)
    path = f"{root}/run_id={run_id}"
    batch.write.mode("errorifexists").parquet(path)
    stored = spark.read.schema(log.schema).parquet(path)
    counted = stored.groupBy(*eventlog.TOPIC).agg(
        F.count(F.lit(1)).alias("rows"), (F.max("offset") + 1).alias("next_offset")
    )
    after, rows = json.loads(json.dumps(before)), 0
    for r in counted.collect():
        after.setdefault(r["topic"], {})[str(r["partition"])] = r["next_offset"]
        rows += r["rows"]
    if after != before:
        _commit(spark, state_path, owner, run_id, recorded_at, before, after)
    return IngestRun(run_id, path if rows else None, rows, after)
