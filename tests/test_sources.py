"""Incremental sources, state, exports, maintenance, telemetry, parity, streaming."""

import gzip
import json
import os
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from lamina.operators import export, ingest, loads, maintenance, parity, state, telemetry
from lamina.operators.export import ExportRefused, Publish
from lamina.sources import database, eventlog, files, landing, objects, paged
from lamina.streaming import batches

UTC = timezone.utc


def put(path, text, when=None):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as handle:
        handle.write(text)
    if when:
        os.utime(path, (when.timestamp(), when.timestamp()))


def test_listing(spark, folder):
    put(f"{folder}/a.txt", "abc", datetime(2024, 1, 1, tzinfo=UTC))
    put(f"{folder}/nested/b.json", "{}", datetime(2024, 1, 2, tzinfo=UTC))
    found = {r["key"]: r["size_bytes"] for r in objects.list_objects(spark, folder).collect()}
    assert found == {"a.txt": 3, "nested/b.json": 2}
    flat = objects.list_objects(spark, folder, recursive=False)
    assert [r["key"] for r in flat.collect()] == ["a.txt"]
    inner = objects.list_objects(spark, folder, "nested", recursive=False)
    assert [r["key"] for r in inner.collect()] == ["nested/b.json"]
    assert objects.list_objects(spark, folder, "missing").count() == 0
    assert [r["key"] for r in objects.first_objects(
        objects.list_objects(spark, folder), 1).collect()] == ["a.txt"]


def test_sync_rules(spark):
    t0 = datetime(2024, 1, 10, tzinfo=UTC)
    early, late = t0 - timedelta(days=1), t0 + timedelta(days=1)
    listing = spark.createDataFrame(
        [("same", 1, early), ("grown", 2, early), ("touched", 1, late), ("new", 1, late),
         ("late drop", 1, early), ("no time", 1, None), ("empty entry", 1, late),
         ("seen no time", 1, None)],
        objects.LISTING_SCHEMA,
    )
    seen = spark.createDataFrame(
        [("same", 1, early), ("grown", 1, early), ("touched", 1, early),
         ("empty entry", None, None), ("seen no time", 1, None)],
        "key string, seen_size bigint, seen_modified timestamp",
    )
    out = {r["key"]: r["should_sync"] for r in objects.sync_decisions(listing, seen, t0).collect()}
    assert out == {"same": False, "grown": True, "touched": True, "new": True, "late drop": False,
                   "no time": True, "empty entry": True, "seen no time": False}
    first = objects.sync_decisions(listing, seen.limit(0), None)
    assert first.filter("should_sync").count() == 8
    full = objects.sync_decisions(listing, seen, t0, "full")
    assert full.filter("should_sync").count() == 8
    synced = listing.filter("key IN ('grown', 'new')")
    after = {r["key"]: r["seen_size"] for r in objects.seen_after(seen, synced).collect()}
    assert after["grown"] == 2 and after["new"] == 1 and after["same"] == 1
    newest = objects.last_synced_after(synced, t0).select(F.unix_micros("last_synced_at")).first()[0]
    assert newest == int(late.timestamp()) * 1000000
    unchanged = objects.last_synced_after(synced.limit(0), t0)
    assert unchanged.select(F.unix_micros("last_synced_at")).first()[0] == int(t0.timestamp()) * 1000000


def test_watermarks(spark, folder):
    df = spark.createDataFrame(
        [(1, "2026-01-01T00:00", "a"), (2, "2026-01-03T00:00", "a"), (3, "2026-01-05T00:00", "b")],
        "id int, updated_at string, status string",
    )
    start = database.start_watermark(None, "updated_at", "2026-01-02T12:00")
    pulled = database.delta(df, "updated_at", start)
    assert pulled.count() == 2
    assert database.watermark_after(pulled, "updated_at", start).first()[0] == "2026-01-05T00:00"
    none = pulled.limit(0)
    assert database.watermark_after(none, "updated_at", start).first()[0] == start
    assert database.delta(df, "updated_at", start, ["status = 'a' OR id = 9", "id < 9"]).count() == 1
    stored = {"updated_at": "2026-02-01"}
    assert database.start_watermark(stored, "updated_at", "x") == "2026-02-01"
    assert database.start_watermark(stored, "updated_at", "x", static=True) == "x"
    with pytest.raises(ValueError):
        database.start_watermark({}, "updated_at")
    assert database.fill("d={today.date} r={run.id}", {"today": {"date": "x"}, "run": {"id": 1}}) == "d=x r=1"
    with pytest.raises(KeyError):
        database.fill("{nothing}", {})
    with pytest.raises(ValueError):
        database.read_database(spark, "jdbc:x", table="t", query="q")
    df.write.parquet(f"{folder}/t")
    scan = database.delta(spark.read.parquet(f"{folder}/t"), "updated_at", start)
    assert "GreaterThan(updated_at" in scan._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("cap", [1, 7, 13, 100])
@pytest.mark.parametrize("width", [1, 5, 16, 1000])
def test_first_messages_of_every_topic_partition(spark, cap, width):
    rows = [(t, p, o) for t, p in (("t", 0), ("t", 1), (None, 0), ("u", None)) for o in range(0, 40, 2 + (p or 0))]
    log = spark.createDataFrame([*rows, ("v", 0, 5)], "topic string, partition int, offset bigint")
    want = [r for t, p in {r[:2] for r in rows} for r in sorted(x for x in rows if x[:2] == (t, p))[:cap]]
    found = [tuple(r) for r in eventlog.first_messages(log, cap, width).collect()]
    assert sorted(found, key=str) == sorted([*want, ("v", 0, 5)], key=str)


def test_log_reading_and_offsets(spark, folder):
    line = {"topic": "t", "partition": 0, "offset": 4, "key": "k", "value": "{}", "headers": {"h": "1"}}
    put(f"{folder}/log.jsonl", json.dumps(line) + "\n\n" + json.dumps({"topic": "t", "partition": 1}) + "\n")
    log = eventlog.read_log(spark, f"{folder}/log.jsonl")
    assert sorted(r["offset"] for r in log.collect()) == [-1, 4]
    starts = spark.createDataFrame([("t", 0, 5)], "topic string, partition int, start_offset bigint")
    assert eventlog.from_offsets(log, starts, default=-1).first()["partition"] == 1
    before = spark.createDataFrame([("t", 0, 2), ("z", 0, 9)], "topic string, partition int, next_offset bigint")
    after = {(r["topic"], r["partition"]): r["next_offset"]
             for r in eventlog.offsets_after(log, before).collect()}
    assert after == {("t", 0): 5, ("t", 1): 0, ("z", 0): 9}
    put(f"{folder}/bad.jsonl", "{broken\n")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|malformed"):
        eventlog.read_log(spark, f"{folder}/bad.jsonl").collect()
    assert eventlog.start_offset(7, 3) == 7
    assert eventlog.start_offset(None, 3) == 3
    assert eventlog.start_offset(None, None) == 0
    assert eventlog.start_offset(7, 3, earliest=True) == 0


def test_envelopes_keep_bad_bytes_readable(spark):
    df = spark.createDataFrame([("t", 1, bytearray(b"ok\xff"))], "topic string, offset bigint, value binary")
    out = eventlog.decode(eventlog.encode(df), "topic string, offset bigint, value string").first()
    assert tuple(out) == ("t", 1, "ok�")


ITEMS = [{"id": i} for i in range(7)]


def fetch_with_total(params, options):
    start = (params["page"] - 1) * params["page_size"]
    return {"data": {"items": ITEMS[start:start + params["page_size"]]}, "total": len(ITEMS)}


def fetch_offset(params, options):
    return {"items": ITEMS[params["offset"]:params["offset"] + params["page_size"]]}


def fetch_cursor(params, options):
    at = int(params.get("cursor", 0))
    return {"items": ITEMS[at:at + 3], "next": str(at + 3) if at + 3 < len(ITEMS) else None}


def ids(df):
    return sorted(json.loads(r["item"])["id"] for r in df.collect())


@pytest.fixture(scope="module")
def fetchers():
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])


def test_pages_in_parallel(spark, fetchers):
    paging = paged.Paging("page", 3, items_path="data.items", total_path="total")
    df = paged.read_pages(spark, paging, fetch_with_total)
    assert df.rdd.getNumPartitions() == 3
    assert ids(df) == list(range(7))
    resumed = paged.Paging("page", 3, start=2, items_path="data.items", total_path="total")
    assert ids(paged.read_pages(spark, resumed, fetch_with_total)) == [3, 4, 5, 6]
    capped = paged.Paging("page", 3, max_pages=1, items_path="data.items", total_path="total")
    assert ids(paged.read_pages(spark, capped, fetch_with_total)) == [0, 1, 2]
    assert paged.resume_after(paging, 3) == 4


def test_many_pages_share_partitions(spark, fetchers, monkeypatch):
    monkeypatch.setattr(paged, "MAX_PARTITIONS", 2)
    paging = paged.Paging("page", 2, items_path="data.items", total_path="total")
    assert ids(paged.read_pages(spark, paging, fetch_with_total)) == list(range(7))
    planned = paged._Reader(paging, fetch_with_total, {}).partitions()
    assert [(p.first, p.end) for p in planned] == [(0, 2), (2, 4)]


def test_walked_pages(spark, fetchers):
    assert ids(paged.read_pages(spark, paged.Paging("offset", 3, items_path="items"), fetch_offset)) == list(range(7))
    cursor = paged.Paging("cursor", items_path="items", cursor_path="next")
    assert ids(paged.read_pages(spark, cursor, fetch_cursor)) == list(range(7))
    two = paged.Paging("cursor", items_path="items", cursor_path="next", max_pages=2)
    assert ids(paged.read_pages(spark, two, fetch_cursor)) == list(range(6))


def test_paging_rules():
    assert paged.at_path({"a": [{"b": 1}]}, "a.0.b") == 1
    with pytest.raises(KeyError):
        paged.at_path({"a": []}, "a.0")
    for bad in (dict(mode="x"), dict(mode="offset"), dict(mode="cursor")):
        with pytest.raises(ValueError):
            paged.Paging(**bad)


def test_unwrap(spark):
    schema = "run int, body struct<pages:array<struct<items:array<struct<id:int>>>>, one:struct<x:int>>"
    df = spark.createDataFrame([(1, (([([(1,), (2,)],)]), (9,)))], schema)
    assert [tuple(r) for r in paged.unwrap(df, "body.pages.0.items", ["run"]).collect()] == [(1, 1), (1, 2)]
    assert paged.unwrap(df, "body.one").first()["x"] == 9
    with pytest.raises(Exception):
        paged.unwrap(df, "body.nothing")


def test_landing_refuses_overwrite(spark, folder):
    landing.land(spark.range(3), f"{folder}/raw", "jsonl")
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        landing.land(spark.range(3), f"{folder}/raw", "jsonl")
    rows = landing.landed_manifest(spark, f"{folder}/raw", run_id="r", source="s", entity="e",
                                   payload_format="jsonl").collect()
    assert rows and all(len(r["artifact_id"]) == 24 and len(r["content_hash"]) == 64 for r in rows)


def test_checkpoint_history(spark, folder):
    path = f"{folder}/state"
    owner = dict(environment="e", source_name="s", entity_name="t")

    def commit(day, after, before=None, run="r"):
        return state.commit(
            spark, path, **owner, run_id=f"{run}{day}", recorded_at=datetime(2024, 1, day),
            checkpoint_after=after, checkpoint_before=before,
            window_start=datetime(2024, 1, day), window_end=datetime(2024, 1, day + 1),
        )

    assert commit(1, "a") and commit(5, "b", "a") and not commit(6, "b", "b") and not commit(6, None)
    history = state.read_history(spark, path)
    assert state.current(history).first()["checkpoint_after"] == "b"
    assert state.backfill_seed(history, datetime(2024, 1, 3)).first()["run_id"] == "r1"
    assert state.backfill_seed(history, datetime(2024, 1, 1)).count() == 0
    with pytest.raises(ValueError):
        state.backfill_seed(history, None)
    found = state.replay_entries(history, None, datetime(2024, 1, 2), datetime(2024, 1, 4))
    assert [r["run_id"] for r in found.collect()] == ["r1"]
    assert state.replay_entries(history, "r5").count() == 1
    assert state.rerun_selection(history, "r5")["window_end"] == datetime(2024, 1, 6)
    with pytest.raises(ValueError):
        state.rerun_selection(history, "other")
    assert state.window_label(None, None) == "open"
    assert history.filter("run_id = 'r1'").first()["window_label"] == "2024-01-01_to_2024-01-02"


def mart(spark):
    return spark.createDataFrame(
        [("2024-01-01", 10, 'say "hi", ok'), ("2024-01-02", 25, None)],
        "order_date string, total int, note string",
    )


def files_below(path):
    return [os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.startswith("part-")]


def test_exports(spark, folder):
    spec = Publish("sales", "daily", "csv", replacement="overwrite_in_place", max_rows=5, order_by=("total",))
    rows = export.publish(mart(spark), spec, folder, "r1", single_file=True).collect()
    paths = export.plan_paths(spec, folder, "r1")
    (run_file,) = files_below(paths["run"])
    text = open(run_file, encoding="utf-8").read().splitlines()
    assert text[0] == "order_date,total,note"
    assert text[1:] == ['2024-01-01,10,"say ""hi"", ok"', "2024-01-02,25,"]
    assert rows[0]["total_rows"] == 2 and rows[0]["size_bytes"] == os.path.getsize(run_file)
    assert files_below(paths["stable"])
    lines = Publish("sales", "daily", "jsonl", ("note",), compression="gzip",
                    replacement="append_new_artifact", max_rows=5)
    export.publish(mart(spark), lines, folder, "r2", single_file=True)
    (packed,) = files_below(export.plan_paths(lines, folder, "r2")["stable"])
    assert '{"note":null}' in gzip.open(packed, "rt").read()
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        export.publish(mart(spark), spec, folder, "r1")


@pytest.mark.parametrize("spec,match", [
    (dict(max_rows=1), "ceiling"), (dict(required_columns=("x",)), "missing"),
    (dict(columns=("x",)), "missing"),
])
def test_refused_exports(spark, folder, spec, match):
    publish = Publish("sales", "daily", **spec)
    with pytest.raises(ExportRefused, match=match):
        export.publish(mart(spark), publish, folder, "r1")
    assert files_below(f"{folder}/level5") == []
    with pytest.raises(ExportRefused, match="no rows"):
        export.publish(mart(spark).limit(0), Publish("sales", "daily"), folder, "r1")


def test_export_paths():
    spec = Publish("d", "n", path_template="{domain}/{window_label}/{publish_name}.{output_extension}")
    assert export.render_path(spec, "r") == "d/open_window/n.csv"
    for bad in ("/abs", "a/../b", "{nothing}"):
        with pytest.raises(ValueError):
            export.render_path(Publish("d", "n", path_template=bad), "r")
    for bad in (dict(format="xlsx"), dict(replacement="x"), dict(replacement="partition_replace")):
        with pytest.raises(ValueError):
            Publish("d", "n", **bad)


def test_delivery_definitions_from_files(spark, tmp_path):
    base = {"domain": "geo", "source": {"dataset": "places"},
            "delivery": {"output_format": "jsonl", "path_template": "{publish_name}.{output_extension}"}}
    for name, mode, sql in (("all", "direct", None), ("few", "query", "SELECT id FROM places WHERE id < 2")):
        where = tmp_path / "defs" / "geo" / name
        where.mkdir(parents=True)
        (where / "manifest.json").write_text(json.dumps(
            {**base, "name": name, "source": {**base["source"], "selection_mode": mode}}))
        if sql:
            (where / "query.sql").write_text(sql)
    specs = export.discover(str(tmp_path / "defs"))
    assert [s.name for s in specs] == ["all", "few"] and export.discover(str(tmp_path / "defs"), "geo.f*") == specs[1:]
    for spec, count in zip(specs, (5, 2)):
        found = export.deliver(spark, spec, lambda name: spark.range(5), str(tmp_path / "out"), "r")
        assert found.first()["total_rows"] == count
    with pytest.raises(ValueError, match="query.sql"):
        export.publish_from_dict({**base, "name": "x", "source": {"dataset": "d", "selection_mode": "query"}})
    with pytest.raises(ValueError, match="required"):
        export.publish_from_dict({**base, "name": "x", "columns": ["a"], "validation": {"required_columns": ["b"]}})
    (tmp_path / "defs" / "geo" / "all" / "manifest.json").write_text(json.dumps({**base, "name": "other"}))
    with pytest.raises(ValueError, match="manifest says"):
        export.discover(str(tmp_path / "defs"))


def test_compaction(spark, folder):
    path = f"{folder}/t"
    df = spark.range(60).withColumn("p", (F.col("id") % 2).cast("int"))
    df.filter("p = 0").repartition(6).write.partitionBy("p").parquet(path)
    df.filter("p = 1").coalesce(1).write.mode("append").partitionBy("p").parquet(path)
    before = {f for f in files_below(path) if "p=1" in f}
    report = maintenance.report(spark, [path, path]).collect()
    assert [(r["files"], r["partitions_to_compact"]) for r in report] == [(7, 1)]
    maintenance.compact(spark, path, ["p"])
    assert spark.read.parquet(path).count() == 60
    assert len([f for f in files_below(path) if "p=0" in f]) == 1
    assert before == {f for f in files_below(path) if "p=1" in f}
    assert maintenance.compact(spark, path, ["p"]) is None
    with pytest.raises(ValueError):
        maintenance.compact(spark, path, ["p"], strategy="sort")


def test_expiry_and_orphans(spark):
    now = datetime(2024, 2, 1)
    runs = spark.createDataFrame(
        [("t", f"r{i}", datetime(2024, 1, i)) for i in (1, 2, 28, 30)] + [("u", "r1", datetime(2023, 1, 1))],
        "tbl string, run_id string, written_at timestamp_ntz",
    )
    gone = maintenance.expired_runs(runs, now, ["tbl"])
    assert sorted((r["tbl"], r["run_id"]) for r in gone.collect()) == [("t", "r1"), ("t", "r2")]
    kept_more = maintenance.expired_runs(runs, now, ["tbl"], retain_last=3)
    assert [r["run_id"] for r in kept_more.collect()] == ["r1"]
    files = spark.createDataFrame(
        [("a", datetime(2024, 1, 1)), ("b", datetime(2024, 1, 1)), ("c", datetime(2024, 1, 31, 20))],
        "path string, modified timestamp_ntz",
    )
    known = spark.createDataFrame([("a",)], "path string")
    assert [r["path"] for r in maintenance.orphan_files(files, known, now, 0).collect()] == ["b"]


def test_telemetry(spark):
    t = datetime(2024, 1, 1)
    audit = spark.createDataFrame(
        [("r1", "sql", "j", "e", "manual", "success", t, t + timedelta(seconds=2), 5, None, None,
          {"My Key": 1.5}, [("c", None)], None),
         ("r2", "sql", "j", "e", "manual", "failed", t, None, None, None, None, None, None, "RETRY_X"),
         ("r3", "sql", "j", "e", "manual", "failed", t, None, None, None, None, None, None, None)],
        telemetry.AUDIT_SCHEMA,
    )
    points = telemetry.run_metrics(audit).collect()
    named = {r["metric_name"]: r["value"] for r in points if r["run_id"] == "r1"}
    assert named == {"run_duration_seconds": 2.0, "records_read_total": 5.0, "run_status": 1.0,
                     "extra_my_key": 1.5, "validation_result": 1.0}
    assert [r["value"] for r in points if r["run_id"] == "r2"] == [0.0]
    alerts = {r["run_id"]: r["severity"] for r in telemetry.alerts(audit).collect()}
    assert alerts == {"r2": "warning", "r3": "critical"}


def test_parity(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, None)], "id int, v string")
    same = parity.parity_report({"t": df.select("v", "id").repartition(4)})
    out = parity.compare_reports(parity.parity_report({"t": df}), same)
    assert parity.all_match(out)
    moved = df.filter("id = 1").unionByName(df.filter("id = 1")).unionByName(df.filter("id = 2").limit(1))
    apart = parity.compare_reports(parity.parity_report({"t": df}), parity.parity_report({"t": moved}))
    assert apart.first()["status"] == "mismatch"
    swapped = spark.createDataFrame([(1, None), (2, "a"), (2, None)], "id int, v string")
    assert not parity.all_match(
        parity.compare_reports(parity.parity_report({"t": df}), parity.parity_report({"t": swapped}))
    )
    diff = parity.row_differences(df, moved)
    assert sorted((r["id"], r["side"]) for r in diff.collect()) == [(1, "right"), (2, "left")]
    with pytest.raises(ValueError):
        parity.row_differences(df, df.drop("v"))


def test_a_retried_batch_replaces_itself(spark, folder):
    sink = batches.batch_table(f"{folder}/out")
    for _ in range(2):
        sink(spark.range(5), 0)
    sink(spark.range(3), 1)
    assert spark.read.parquet(f"{folder}/out").count() == 8


def test_stream_resumes_from_its_checkpoint(spark, folder):
    source, out, checkpoint = (f"{folder}/{x}" for x in ("in", "out", "state"))
    schema = spark.range(1).schema
    for low in (0, 10):
        spark.range(low, low + 10).write.mode("append").parquet(source)
        stream = batches.read_files(spark, source, schema, max_files=3)
        batches.run_available(stream, batches.batch_table(out), checkpoint)
    stored = spark.read.parquet(out)
    assert sorted(r["id"] for r in stored.collect()) == list(range(20))


def test_read_table_keeps_partition_text(spark, folder):
    df = spark.createDataFrame([(1, "2026-01-01")], "id int, d string")
    loads.load(df, f"{folder}/t", "partition_overwrite", ["d"])
    assert loads.read_table(spark, f"{folder}/t", df.schema).first()["d"] == "2026-01-01"


def many_files(spark, path, days, per_day, **more):
    """``per_day`` files of one row each for every day (text such as 007)."""
    for i in range(per_day):
        rows = spark.createDataFrame([(10 * i + d, f"00{d}") for d in days], "id long, day string")
        rows.coalesce(1).write.mode("append").partitionBy("day").parquet(path)


def test_compaction_keeps_all_rows_and_text_partitions(spark, folder):
    path = f"{folder}/t"
    many_files(spark, path, range(7, 10), 6)
    many_files(spark, path, [3], 2)
    schema = spark.createDataFrame([], "id long, day string").schema
    before = sorted(map(tuple, loads.read_table(spark, path, schema).collect()))
    with pytest.raises(ValueError, match="partitioned by"):
        maintenance.compact(spark, path, [])
    with pytest.raises(ValueError, match="partitioned by"):
        maintenance.compact(spark, path, ["id"])
    assert maintenance.compact(spark, path).rows_written == 18
    assert sorted(map(tuple, loads.read_table(spark, path, schema).collect())) == before
    files = maintenance.list_files(spark, path).groupBy("directory").count().collect()
    assert sorted((r["directory"][-7:], r["count"]) for r in files) == [
        ("day=003", 2), ("day=007", 1), ("day=008", 1), ("day=009", 1),
    ]
    assert maintenance.compact(spark, path) is None


def test_compaction_of_an_unpartitioned_table(spark, folder):
    for i in range(6):
        spark.range(i, i + 1).coalesce(1).write.mode("append").parquet(f"{folder}/t")
    assert maintenance.compact(spark, f"{folder}/t").rows_written == 6
    assert sorted(r["id"] for r in spark.read.parquet(f"{folder}/t").collect()) == list(range(6))
    assert maintenance.list_files(spark, f"{folder}/t").count() == 1


def test_orphans_and_runs_are_removed(spark, folder):
    many_files(spark, f"{folder}/t", [1, 2], 2)
    files = maintenance.list_files(spark, f"{folder}/t")
    known = files.filter(F.col("directory").endswith("day=001")).select("path")
    gone = maintenance.orphan_files(files, known, datetime(2100, 1, 1))
    assert maintenance.remove_files(spark, gone) == 2
    assert maintenance.list_files(spark, f"{folder}/t").count() == 2
    runs = spark.createDataFrame([(f"{folder}/t/day=001",), (None,)], "path string")
    assert maintenance.remove_runs(spark, runs) == 1
    assert not os.path.exists(f"{folder}/t/day=001")


def test_ordered_delivery_of_several_parts(spark, folder):
    spec = export.Publish("d", "ordered", "jsonl", order_by=("id",))
    rows = spark.range(4000).repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        export.publish(rows, spec, folder, "r1")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    path = export.plan_paths(spec, folder, "r1")["run"]
    parts = sorted(f for f in os.listdir(path) if f.startswith("part-"))
    found = [json.loads(line)["id"] for f in parts for line in open(f"{path}/{f}", encoding="utf-8")]
    assert len(parts) > 1 and found == list(range(4000))


def test_broken_json_lines_fail_or_are_kept_whole(spark, folder):
    put(f"{folder}/x.jsonl", '{"a": 1}\n{"a": \n{"a": 3}\n')
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|malformed"):
        files.scan_json_lines(spark, f"{folder}/x.jsonl", "a int").collect()
    found = files.scan_json_lines(spark, f"{folder}/x.jsonl", "a int", broken="_broken").collect()
    assert sorted((r["a"], r["_broken"]) for r in found if r["a"]) == [(1, None), (3, None)]
    assert [r["_broken"] for r in found if r["a"] is None] == ['{"a": ']


def test_data_columns_named_like_level2_folders_survive(spark, folder):
    df = spark.createDataFrame([(1, 5), (2, 6)], "id int, run_id int")
    where = dict(source="s", entity="e", table="t")
    landing.write_level2(df, folder, **where, mapping_version="m", run_id="r1")
    found = landing.read_level2(spark, folder, "s", "e", "t").collect()
    assert sorted((r["id"], r["data__run_id"], r["run_id"]) for r in found) == [(1, 5, "r1"), (2, 6, "r1")]


def test_sink_takes_a_repeated_event_once(spark, folder):
    schema = spark.createDataFrame([], "k int, v string, at int, day string").schema
    sink = batches.upsert_table(f"{folder}/t", schema, ["k"], ["day"], ["at"])
    twice = spark.createDataFrame([(1, "a", 1, "x"), (1, "a", 1, "x"), (1, "b", 2, "y"), (2, "c", 1, "x")], schema)
    for number in range(2):
        sink(twice, number)
    stored = loads.read_table(spark, f"{folder}/t", schema)
    assert sorted(map(tuple, stored.collect())) == [(1, "b", 2, "y"), (2, "c", 1, "x")]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "string", "bigint"])
def test_watermark_runs_commit_after_persisting(spark, folder, kind):
    owner = {"environment": "e", "source_name": "s", "entity_name": kind}
    stamps = [f"2024-01-0{d} 00:00:00.5" for d in range(1, 5)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(stamps)], "id int, t string")
    df = df.withColumn("w", F.col("id").cast("bigint") if kind == "bigint" else F.col("t").cast(kind))
    default = {"bigint": -1, "string": "2024"}.get(kind, datetime(2023, 1, 1))

    def run(number, rows):
        return ingest.run_watermark_delta(
            rows, "w", root=f"{folder}/{kind}", state_path=f"{folder}/state", owner=owner,
            run_id=f"r{number}", recorded_at=datetime(2024, 1, number), default=default,
        )

    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert run(1, df.filter("id < 2")).rows == 2
        assert run(2, df).rows == 2
        last = run(3, df)
        assert (last.rows, last.path) == (0, None)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert ingest.load_checkpoint(spark, f"{folder}/state", owner) == last.checkpoint
    assert state.read_history(spark, f"{folder}/state").count() == 2
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        run(1, df)


def test_windows_close_behind_the_watermark(spark, folder):
    source, out, checkpoint = (f"{folder}/{x}" for x in ("in", "out", "state"))
    rows = [(datetime(2024, 1, d, h), "a" if h % 2 else "b") for d in (1, 2, 3) for h in range(0, 24, 3)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, kind string")
    df.write.parquet(source)
    stream = batches.windowed_counts(
        batches.read_files(spark, source, df.schema), "ts", "1 day", ["kind"], lateness="1 hour"
    )
    batches.run_available(stream, batches.batch_table(out), checkpoint)
    closed = spark.read.parquet(out)
    assert closed.filter("n = 4").count() == closed.count() == 4  # two days, two kinds


def test_a_cluster_must_name_a_shared_folder():
    from types import SimpleNamespace

    from lamina.session import shared_root

    def session(master, setting):
        conf = SimpleNamespace(get=lambda key, default=None: setting)
        context = SimpleNamespace(
            master=master, applicationId="app", getCheckpointDir=lambda: None,
            getConf=lambda: SimpleNamespace(get=lambda key, default=None: setting),
        )
        return SimpleNamespace(conf=conf, sparkContext=context)

    assert shared_root(session("yarn", "hdfs://cluster/checkpoints/")) == "hdfs://cluster/checkpoints"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_root(session("yarn", None))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_root(session("local[2]", None))


def test_range_shaped_pulls_are_partitioned(spark):
    with pytest.raises(Exception, match="No suitable driver|ClassNotFound|driver"):
        database.read_database(
            spark, "jdbc:nothing:x", query="SELECT 1", partition_column="id", bounds=(0, 10), partitions=2
        )
