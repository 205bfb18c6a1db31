"""Windows that close, state that expires, and late rows that are kept."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lamina.streaming import batches, windows

START = datetime(2024, 3, 1)
SCHEMA = "k string, at timestamp, n int"


@pytest.fixture
def run(spark, folder):
    """Append rows of (key, hours since START, number) to the source and run a stream built from it."""

    def go(rows, build, name="a", sink=None):
        rows = [(k, None if h is None else START + timedelta(hours=h), n) for k, h, n in rows]
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = batches.read_files(spark, f"{folder}/in", SCHEMA)
        sink = sink or batches.batch_table(f"{folder}/out-{name}")
        return batches.run_available(build(stream), sink, f"{folder}/state-{name}")

    return go


def test_state_holds_open_windows_only(spark, folder, run):
    def build(stream):
        return windows.closing_counts(stream, "at", "1 hour", ["k"], "3 hours")

    kept, removed = [], 0
    for day in range(4):
        rows = [(k, 24 * day + h, 1) for k in "ab" for h in range(24)]
        progress = run(rows, build)
        kept.append(progress[-1]["stateOperators"][0]["numRowsTotal"])
        removed += sum(p["stateOperators"][0]["numRowsRemoved"] for p in progress)
    # the newest row of a run begins the last hour; windows of the last three hours and its own are open
    assert kept == [8] * 4 and removed == 2 * 96 - 8
    closed = spark.read.parquet(f"{folder}/out-a").drop(batches.BATCH)
    still = windows.open_windows(spark, f"{folder}/state-a", ["k"])
    assert closed.count() == 2 * 96 - 8 and still.count() == 8
    whole = closed.unionByName(still)
    assert whole.distinct().count() == 2 * 96 and whole.where("n <> 1").count() == 0


def test_sessions_merge_over_runs_and_expire(spark, folder, run):
    def build(stream):
        return windows.closing_sessions(stream, "at", "2 hours", ["k"], "1 hour")

    run([("a", 0, 1), ("a", 1.5, 1), ("b", 0, 1)], build)
    run([("a", 3, 1), ("b", 4, 1)], build)
    progress = run([("c", 40, 1)], build)
    assert progress[-1]["stateOperators"][0]["numRowsTotal"] == 1
    found = spark.read.parquet(f"{folder}/out-a").collect()
    hours = {(r.k, (r.session_start - START) / timedelta(hours=1), (r.session_end - START) / timedelta(hours=1), r.n) for r in found}
    assert hours == {("a", 0, 5, 3), ("b", 0, 2, 1), ("b", 4, 6, 1)}


def test_first_occurrences_forget_what_the_watermark_passed(spark, folder, run):
    def build(stream):
        return windows.first_occurrences(stream, ["k"], "at", "5 hours")

    run([("a", 0, 1), ("a", 0, 1), ("b", 2, 1)], build)
    run([("a", 3, 1), ("c", 12, 1)], build)
    progress = run([("a", 13, 2), ("b", 1, 2)], build)
    # "a" comes again when its state has gone, "b" behind the watermark is dropped
    assert sorted((r.k, r.n) for r in spark.read.parquet(f"{folder}/out-a").collect()) == [("a", 1), ("a", 2), ("b", 1), ("c", 1)]
    assert progress[-1]["stateOperators"][0]["numRowsTotal"] == 2


def test_late_rows_are_kept_aside_and_a_replay_changes_nothing(spark, folder, run):
    sink = windows.route_late_rows(f"{folder}/routed", "at", "2 hours")
    schema = spark.createDataFrame([], SCHEMA).schema
    out = f"{folder}/out-b"

    def count():
        rows = windows.punctual_rows(spark, f"{folder}/routed", schema, "at")
        counts = windows.closing_counts(rows, "at", "1 hour", ["k"], "2 hours")
        return batches.run_available(counts, batches.batch_table(out), f"{folder}/state-b")

    arrivals = [
        [("a", 0, 1), ("a", 10, 1), ("x", None, 1)],
        [("a", 8, 2), ("a", 7.9, 2), ("a", 9, 2)],
        [("a", 30, 3), ("b", 8.5, 3)],
        [("b", 1, 4), ("b", 29, 4), ("b", 28, 4)],
    ]
    for rows in arrivals:
        run(rows, lambda stream: stream, "route", sink)
        progress = count()
        assert all(p["stateOperators"][0]["numRowsDroppedByWatermark"] == 0 for p in progress)
    late = windows.late_rows(spark, f"{folder}/routed", schema, "at").collect()
    hours = sorted(((r.at - START) / timedelta(hours=1) if r.at else -1, r.n, r[batches.BATCH]) for r in late)
    assert hours == [(-1, 1, 0), (1, 4, 3), (7.9, 2, 1)]
    total = spark.read.parquet(out).drop(batches.BATCH).unionByName(windows.open_windows(spark, f"{folder}/state-b", ["k"]))
    assert total.agg(F.sum("n")).first()[0] == sum(map(len, arrivals)) - len(late)
    replayed = [("a", START + timedelta(hours=h), 2) for h in (8, 7.9, 9)]
    sink(spark.createDataFrame(replayed, SCHEMA), 1)
    again = windows.late_rows(spark, f"{folder}/routed", schema, "at").collect()
    assert sorted(map(str, again)) == sorted(map(str, late))


def test_open_windows_of_another_state_are_refused(spark, folder, run):
    run([("a", 0, 1)], lambda s: s.withWatermark("at", "1 hour").groupBy(F.window("at", "1 hour")).agg(F.sum("n"), F.max("n")))
    with pytest.raises(ValueError, match="windowed counts"):
        windows.open_windows(spark, f"{folder}/state-a", [])
