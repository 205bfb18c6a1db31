"""Incremental sources: file sync, watermarks, event logs, paged pulls, run state."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.functions.literals import literal
from lamina.operators import ingest, state
from lamina.session import scratch
from lamina.sources import database, eventlog, objects, paged
from lamina.suite import Suite, table

suite = Suite()

# The documents as a file drop, and the state of an earlier sync of the labelled ones:
# files labelled toxic have grown since, files of good quality were touched since.
LAST_SYNC = "2024-01-01 06:00:00"
SYNC_SQL = f"""
    WITH files AS (
        SELECT source || '/' || doc_id AS key, n_chars AS size_bytes, lang,
               TIMESTAMP '2024-01-01 00:00:00' + doc_id * INTERVAL 1 MINUTE AS modified, doc_id
        FROM documents),
    seen AS (
        SELECT f.key, f.size_bytes - l.toxic AS seen_size,
               f.modified - l.quality * INTERVAL 1 HOUR AS seen_modified
        FROM files f JOIN (SELECT doc_id, max(toxic) AS toxic, max(quality) AS quality
                           FROM labels GROUP BY doc_id) l ON l.doc_id = f.doc_id),
    decided AS (
        SELECT f.key, f.size_bytes, f.modified,
               CASE WHEN s.key IS NULL THEN f.modified > TIMESTAMP '{LAST_SYNC}'
                    ELSE s.seen_size <> f.size_bytes OR s.seen_modified <> f.modified END
                   AS should_sync
        FROM files f LEFT JOIN seen s ON s.key = f.key)
"""


def file_drop(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    start = literal(datetime(2024, 1, 1), T.TimestampNTZType())
    minutes = lambda n: F.make_dt_interval(mins=n)
    files = table(spark, sf_dir, "documents").select(
        F.concat_ws("/", "source", "doc_id").alias("key"),
        F.col("n_chars").alias("size_bytes"),
        (start + minutes(F.col("doc_id").cast("int"))).alias("modified"),
        "doc_id",
    )
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(
        F.max("toxic").alias("toxic"), F.max("quality").alias("quality")
    )
    seen = files.join(labels, "doc_id").select(
        "key",
        (F.col("size_bytes") - F.col("toxic")).alias("seen_size"),
        (F.col("modified") - minutes(F.col("quality") * 60)).alias("seen_modified"),
    )
    return files.drop("doc_id"), seen


def _last_sync() -> datetime:
    return datetime.fromisoformat(LAST_SYNC)


@suite.query(f"{SYNC_SQL} SELECT key, size_bytes, should_sync FROM decided")
def file_sync_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    files, seen = file_drop(spark, sf_dir)
    return objects.sync_decisions(files, seen, _last_sync()).drop("modified")


@suite.query(f"""
    {SYNC_SQL}
    SELECT key, size_bytes AS seen_size, modified AS seen_modified FROM decided WHERE should_sync
    UNION ALL
    SELECT key, seen_size, seen_modified FROM seen
    WHERE key NOT IN (SELECT key FROM decided WHERE should_sync)
""")
def file_sync_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    files, seen = file_drop(spark, sf_dir)
    synced = objects.sync_decisions(files, seen, _last_sync()).filter("should_sync")
    return objects.seen_after(seen, synced)


@suite.query(f"""
    {SYNC_SQL} SELECT max(modified) AS last_synced_at FROM decided WHERE should_sync
""")
def file_sync_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    files, seen = file_drop(spark, sf_dir)
    synced = objects.sync_decisions(files, seen, _last_sync()).filter("should_sync")
    return objects.last_synced_after(synced, _last_sync())


@suite.query("""
    SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
    WHERE o_orderdate > TIMESTAMP '1999-06-01' AND (o_totalprice > 1000) AND (o_orderstatus <> 'P')
""")
def watermark_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delta after the stored watermark with two more filters, all pushed to the scan."""
    start = database.start_watermark({"o_orderdate": "1999-06-01 00:00:00"}, "o_orderdate")
    pulled = database.delta(
        table(spark, sf_dir, "orders"), "o_orderdate", datetime.fromisoformat(start),
        ["o_totalprice > 1000", "o_orderstatus <> 'P'"],
    )
    return pulled.select("o_orderkey", "o_orderdate", "o_totalprice")


@suite.query("""
    SELECT max(o_orderdate) AS watermark FROM orders WHERE o_orderdate > TIMESTAMP '1999-06-01'
""")
def watermark_advance(spark: SparkSession, sf_dir: str) -> DataFrame:
    before = datetime(1999, 6, 1)
    pulled = database.delta(table(spark, sf_dir, "orders"), "o_orderdate", before)
    return database.watermark_after(pulled, "o_orderdate", before)


# The events as a log: topic by type, partition by leading digit of the user, offsets with
# gaps. Every topic partition starts at the first offset after its first purchase day.
LOG_SQL = """
    SELECT event_type AS topic, CAST(substr(CAST(user_id AS VARCHAR), 1, 1) AS INTEGER) AS partition,
           event_id AS "offset", CAST(user_id AS VARCHAR) AS key, props AS value
    FROM events
"""
STARTS_SQL = f"""
    SELECT topic, partition, max("offset") // 4 AS start_offset
    FROM ({LOG_SQL}) WHERE topic <> 'signup' GROUP BY topic, partition
"""


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("topic"),
        F.substring(F.col("user_id").cast("string"), 1, 1).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
        F.col("user_id").cast("string").alias("key"),
        F.col("props").alias("value"),
        F.create_map(F.lit("type"), F.col("event_type")).alias("headers"),
    )
    path = scratch(spark, "log")
    rows.write.json(path)
    return eventlog.read_log(spark, path)


def replayed(spark: SparkSession, sf_dir: str, cap: int) -> DataFrame:
    log = event_log(spark, sf_dir)
    starts = log.filter("topic <> 'signup'").groupBy(*eventlog.TOPIC).agg(
        F.floor(F.max("offset") / 4).alias("start_offset")
    )
    from_start = eventlog.from_offsets(log, starts)
    return eventlog.first_messages(from_start, cap).select(
        "topic", "partition", "offset", "key", "value"
    )


def replay_sql(cap: int) -> str:
    return f"""
        SELECT topic, partition, "offset", key, value FROM (
            SELECT l.*, row_number() OVER (PARTITION BY topic, partition ORDER BY "offset") AS rn
            FROM ({LOG_SQL}) l LEFT JOIN ({STARTS_SQL}) s USING (topic, partition)
            WHERE l."offset" >= coalesce(s.start_offset, 0))
        WHERE rn <= {cap}
    """


@suite.query(replay_sql(100))
def event_log_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replayed(spark, sf_dir, 100)


@suite.query(replay_sql(1200))
def event_log_replay_large_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replayed(spark, sf_dir, 1200)


@suite.query(f"""
    SELECT topic, partition, max("offset") + 1 AS next_offset FROM ({LOG_SQL}) GROUP BY ALL
""")
def event_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return eventlog.offsets_after(event_log(spark, sf_dir))


@suite.query(f'SELECT topic, partition, "offset", key, value, topic AS type FROM ({LOG_SQL})')
def message_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode as envelopes and decode again; the value stays text inside the envelope."""
    payloads = eventlog.encode(event_log(spark, sf_dir))
    return eventlog.decode(payloads).select(
        "topic", "partition", "offset", "key", "value", F.col("headers")["type"].alias("type")
    )


PAGE = 200


def page_files(spark: SparkSession, sf_dir: str) -> str:
    """Customers as response documents of a paged API, one file per page of PAGE items."""
    customers = table(spark, sf_dir, "customer")
    total = customers.agg(F.count(F.lit(1))).scalar()
    item = F.struct(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"),
    )
    pages = customers.groupBy((F.floor(F.col("c_custkey") / PAGE) + 1).alias("page")).agg(
        F.sort_array(F.collect_list(item)).alias("items")
    )
    documents = pages.withColumn("total", total).select(
        "page", F.to_json(F.struct("items", "total")).alias("value")
    )
    path = scratch(spark, "pages")
    documents.write.partitionBy("page").text(path)
    return path


def fetch_page(params: dict, options: dict) -> dict:
    """Stands in for the transport: answers a page request from the page files."""
    import json

    from pyarrow import fs

    system, root = fs.FileSystem.from_uri(options["folder"])
    folder = fs.FileSelector(f"{root}/page={params['page']}")
    found = [f.path for f in system.get_file_info(folder) if f.base_name.startswith("part-")]
    with system.open_input_stream(found[0]) as stream:
        return json.loads(stream.read())


@suite.query("""
    SELECT c_custkey // 200 + 1 AS page, c_custkey AS id, c_name AS name, c_mktsegment AS segment
    FROM customer
""")
def envelope_unwrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of response envelopes, unwrapped from the landed documents."""
    schema = "items array<struct<id:bigint,name:string,segment:string>>, total bigint"
    docs = spark.read.schema(f"{schema}, page bigint").json(page_files(spark, sf_dir))
    return paged.unwrap(docs, "items", keep=["page"])


# Ingest manifests: one landed artifact per priority and month of orders.
MANIFEST_SQL = """
    SELECT 'test' AS environment, o_orderpriority AS source_name, 'orders' AS entity_name,
           o_orderpriority || ':' || strftime(o_orderdate, '%Y-%m') AS run_id,
           CASE WHEN o_orderpriority = '5-LOW' THEN NULL
                ELSE min(date_trunc('month', o_orderdate)) END AS window_start,
           CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE max(o_orderdate) END AS window_end,
           min(o_orderdate) AS ingest_started_at,
           max(o_orderdate) + INTERVAL 1 DAY AS ingest_completed_at,
           max(o_orderdate) AS recorded_at, count(*) AS rows_landed
    FROM orders GROUP BY o_orderpriority, strftime(o_orderdate, '%Y-%m')
"""


def manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("o_orderdate")
    undated = F.col("source_name") == "5-LOW"
    month = F.date_format(day, "yyyy-MM")
    grouped = table(spark, sf_dir, "orders").groupBy(
        F.col("o_orderpriority").alias("source_name"), month.alias("month")
    ).agg(
        F.min(F.date_trunc("month", day).cast("timestamp_ntz")).alias("first"),
        F.max(day).alias("last"), F.min(day).alias("ingest_started_at"),
        F.count(F.lit(1)).alias("rows_landed"),
    )
    return grouped.select(
        F.lit("test").alias("environment"), "source_name", F.lit("orders").alias("entity_name"),
        F.concat_ws(":", "source_name", "month").alias("run_id"),
        F.when(~undated, F.col("first")).alias("window_start"),
        F.when(~undated, F.col("last")).alias("window_end"),
        "ingest_started_at",
        (F.col("last") + F.make_dt_interval(days=F.lit(1))).alias("ingest_completed_at"),
        F.col("last").alias("recorded_at"), "rows_landed",
    )


@suite.query(f"""
    SELECT run_id, rows_landed FROM ({MANIFEST_SQL})
    WHERE coalesce(window_end, ingest_completed_at) >= TIMESTAMP '1997-02-10'
      AND coalesce(window_start, ingest_started_at) <= TIMESTAMP '1999-05-20'
""")
def manifest_window_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = state.select_manifests(
        manifests(spark, sf_dir), datetime(1997, 2, 10), datetime(1999, 5, 20),
        environment="test", entity_name="orders",
    )
    return chosen.select("run_id", "rows_landed")


@suite.query(f"""
    SELECT source_name, run_id, window_end FROM (
        SELECT *, row_number() OVER (PARTITION BY source_name ORDER BY window_end DESC) AS rn
        FROM ({MANIFEST_SQL}) WHERE window_end <= TIMESTAMP '1998-08-15')
    WHERE rn = 1
""")
def backfill_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = state.backfill_seed(manifests(spark, sf_dir), datetime(1998, 8, 15))
    return found.select("source_name", "run_id", "window_end")


@suite.query(f"""
    SELECT run_id FROM ({MANIFEST_SQL})
    WHERE (window_end IS NULL OR window_end >= TIMESTAMP '2000-01-01')
      AND (window_start IS NULL OR window_start <= TIMESTAMP '2000-03-31')
""")
def replay_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = state.replay_entries(
        manifests(spark, sf_dir), None, datetime(2000, 1, 1), datetime(2000, 3, 31)
    )
    return found.select("run_id")


@suite.query(f"""
    SELECT source_name, run_id, recorded_at FROM (
        SELECT *, row_number() OVER (PARTITION BY source_name ORDER BY recorded_at DESC,
                                     run_id DESC) AS rn FROM ({MANIFEST_SQL}))
    WHERE rn = 1
""")
def current_checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.current(manifests(spark, sf_dir)).select("source_name", "run_id", "recorded_at")


@suite.query("""
    SELECT c_custkey // 200 AS page_index, CAST(c_custkey % 200 AS INTEGER) AS item_index,
           c_custkey AS id, c_name AS name, c_mktsegment AS segment
    FROM customer
""")
def paged_source_pull(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages through the data source, read in parallel because the total is known."""
    paging = paged.Paging("page", PAGE, items_path="items", total_path="total")
    pulled = paged.read_pages(spark, paging, fetch_page, folder=page_files(spark, sf_dir))
    parsed = F.from_json("item", "id bigint, name string, segment string").alias("item")
    return pulled.select("page_index", "item_index", parsed).select(
        "page_index", "item_index", "item.*"
    )


@suite.query("""
    SELECT o_orderkey, o_orderdate, CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN 'run-1'
           ELSE 'run-2' END AS run_id
    FROM orders WHERE o_orderdate > TIMESTAMP '1995-06-30'
""")
def incremental_database_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three delta runs against a growing source; the last finds nothing new."""
    root, state_path = scratch(spark, "ingest"), scratch(spark, "state")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    cut = literal(datetime(1998, 1, 1), T.TimestampNTZType())
    owner = {"environment": "test", "source_name": "shop", "entity_name": "orders"}
    snapshots = (orders.filter(F.col("o_orderdate") < cut), orders, orders)
    for i, snapshot in enumerate(snapshots, start=1):
        ingest.run_watermark_delta(
            snapshot, "o_orderdate", root=root, state_path=state_path, owner=owner,
            run_id=f"run-{i}", recorded_at=datetime(2024, 1, i), default=datetime(1995, 6, 30),
        )
    schema = T.StructType([*orders.schema.fields, T.StructField("run_id", T.StringType())])
    return spark.read.schema(schema).parquet(root)


@suite.query(f"""
    SELECT topic, partition, "offset", key, CASE WHEN rn <= 150 THEN 'run-1' ELSE 'run-2' END AS run_id
    FROM (SELECT *, row_number() OVER (PARTITION BY topic, partition ORDER BY "offset") AS rn
          FROM ({LOG_SQL})) WHERE rn <= 300
""")
def incremental_log_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two bounded batches of a log; the second starts at the committed offsets."""
    root, state_path = scratch(spark, "ingest"), scratch(spark, "state")
    log = event_log(spark, sf_dir).select("topic", "partition", "offset", "key")
    owner = {"environment": "test", "source_name": "app", "entity_name": "events"}
    for i in (1, 2):
        ingest.run_log_batch(
            log, root=root, state_path=state_path, owner=owner, run_id=f"run-{i}",
            recorded_at=datetime(2024, 1, i), max_messages=150,
        )
    schema = T.StructType([*log.schema.fields, T.StructField("run_id", T.StringType())])
    return spark.read.schema(schema).parquet(root)


@suite.query("""
    SELECT c_mktsegment AS folder, CAST(sum(strlen(c_name) + 1) AS BIGINT) AS bytes FROM customer GROUP BY 1
""")
def object_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing of a file drop with one folder per market segment."""
    drop = scratch(spark, "drop")
    rows = table(spark, sf_dir, "customer").select("c_name", "c_mktsegment")
    rows.write.partitionBy("c_mktsegment").text(f"{drop}/customers")
    listed = objects.list_objects(spark, drop, "customers")
    folder = F.regexp_extract("key", "^customers/c_mktsegment=([^/]+)/part-", 1)
    data = listed.filter(folder != "")
    return data.groupBy(folder.alias("folder")).agg(F.sum("size_bytes").alias("bytes"))
