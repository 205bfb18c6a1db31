"""Exports, table maintenance, telemetry and streaming runs."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.functions.literals import literal
from lamina.operators import export, loads, maintenance, telemetry
from lamina.operators.export import Publish
from lamina.session import scratch
from lamina.streaming import batches, windows
from lamina.suite import Suite, table

suite = Suite()

DAILY = """
    SELECT CAST(o_orderdate AS DATE) AS order_date, count(*) AS orders,
           CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DECIMAL(18,2)) AS total_amount
    FROM orders GROUP BY 1
"""


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "orders").createOrReplaceTempView("orders")
    return spark.sql(DAILY)


@suite.query(f"""
    SELECT CAST(order_date AS VARCHAR) AS order_date, CAST(total_amount AS VARCHAR) AS total_amount
    FROM ({DAILY})
""")
def export_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch(spark, "export")
    spec = Publish("sales", "daily_orders", "csv", ("order_date", "total_amount"),
                   replacement="overwrite_in_place", required_columns=("order_date",))
    export.publish(daily(spark, sf_dir), spec, root, "run-1")
    return spark.read.csv(export.plan_paths(spec, root, "run-1")["stable"], header=True)


@suite.query("""
    SELECT o_orderkey, o_orderpriority,
           CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS status
    FROM orders
""")
def export_jsonl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders as JSON lines, nulls kept."""
    root = scratch(spark, "export")
    spec = Publish("sales", "orders", "jsonl", max_rows=None)
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderpriority",
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("status"),
    )
    export.publish(rows, spec, root, "run-1", "1995_to_2001")
    path = export.plan_paths(spec, root, "run-1")["run"]
    return spark.read.schema(rows.schema).json(path)


@suite.query("""
    SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_mktsegment FROM customer
""")
def export_tsv_compressed(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch(spark, "export")
    spec = Publish("crm", "customers", "tsv", ("c_custkey", "c_name", "c_mktsegment"),
                   replacement="append_new_artifact", compression="gzip", max_rows=None)
    export.publish(table(spark, sf_dir, "customer"), spec, root, "run-1")
    path = export.plan_paths(spec, root, "run-1")["stable"]
    return spark.read.csv(path, header=True, sep="\t")


@suite.query("""
    SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN c_name || ' (new)'
           ELSE c_name END AS c_name, c_mktsegment FROM customer
""")
def export_partition_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second delivery replaces only the segment it holds."""
    root = scratch(spark, "export")
    spec = Publish("crm", "segments", "jsonl", replacement="partition_replace", max_rows=None,
                   partition_columns=("c_mktsegment",))
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    export.publish(rows, spec, root, "run-1")
    fixed = rows.filter("c_mktsegment = 'BUILDING'").withColumn(
        "c_name", F.concat("c_name", F.lit(" (new)"))
    )
    export.publish(fixed, spec, root, "run-2")
    return spark.read.schema(rows.schema).json(export.plan_paths(spec, root, "run-2")["stable"])


@suite.query(f"""
    SELECT 'daily_orders' AS publish_name, 'run-1' AS run_id, count(*) AS total_rows,
           64 AS digest_length FROM ({DAILY})
""")
def export_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The delivery's manifest, reduced to what does not depend on file splits."""
    root = scratch(spark, "export")
    files = export.publish(daily(spark, sf_dir), Publish("sales", "daily_orders"), root, "run-1")
    return files.groupBy("publish_name", "run_id").agg(
        F.max("total_rows").cast("bigint").alias("total_rows"),
        F.max(F.length("sha256")).alias("digest_length"),
    )


def small_files(spark: SparkSession, sf_dir: str) -> str:
    """Orders by year, appended once per priority: several small files per year."""
    path = scratch(spark, "small-files")
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderpriority", "o_totalprice",
        F.year("o_orderdate").alias("order_year"),
    )
    for priority in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"):
        part = rows.filter(F.col("o_orderpriority") == priority)
        loads.load(part, path, "append", ["order_year"])
    return path


@suite.query("""
    SELECT 'order_year=' || year(o_orderdate) AS partition,
           count(DISTINCT o_orderpriority) >= 5 AS enough_small_files
    FROM orders GROUP BY 1
""")
def compaction_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = maintenance.list_files(spark, small_files(spark, sf_dir))
    plan = maintenance.compaction_plan(files)
    return plan.select(
        F.substring_index("directory", "/", -1).alias("partition"),
        (F.col("small_files") >= 5).alias("enough_small_files"),
    )


@suite.query("""
    SELECT o_orderkey, o_orderpriority, o_totalprice,
           CAST(year(o_orderdate) AS INTEGER) AS order_year
    FROM orders
""")
def compact_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = small_files(spark, sf_dir)
    maintenance.compact(spark, path, ["order_year"])
    return spark.read.parquet(path)


RUNS = """
    SELECT o_orderpriority AS table_name, o_custkey AS partition_key, o_orderkey AS run_id,
           o_orderdate AS written_at FROM orders
"""


@suite.query(f"""
    SELECT table_name, partition_key, run_id FROM (
        SELECT *, row_number() OVER (PARTITION BY table_name, partition_key
                                     ORDER BY written_at DESC, run_id DESC) AS rn FROM ({RUNS}))
    WHERE rn > 2 AND written_at < TIMESTAMP '1999-12-25'
""")
def run_expiry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Superseded runs: not among the two newest and older than a week."""
    table(spark, sf_dir, "orders").createOrReplaceTempView("orders")
    gone = maintenance.expired_runs(
        spark.sql(RUNS), datetime(2000, 1, 1), ["table_name", "partition_key"], retain_last=2
    )
    return gone.select("table_name", "partition_key", "run_id")


@suite.query("""
    SELECT url AS path FROM pages
    WHERE page_id NOT IN (SELECT doc_id FROM labels)
      AND TIMESTAMP '2024-01-01' + page_id * INTERVAL 1 HOUR < TIMESTAMP '2024-01-05'
""")
def orphan_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as stored files; those with a label are the ones a manifest knows."""
    written = literal(datetime(2024, 1, 1), T.TimestampNTZType()) + F.make_dt_interval(hours=F.col("page_id").cast("int"))
    pages = table(spark, sf_dir, "pages")
    files = pages.select(F.col("url").alias("path"), written.alias("modified"), "page_id")
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"))
    known = files.join(labels, "page_id", "left_semi").select("path")
    return maintenance.orphan_files(files, known, datetime(2024, 1, 8)).select("path")


# Every order as one run: status F is a success, O a failure, P a failure after a time-out.
AUDIT_SQL = """
    SELECT CAST(o_orderkey AS {text}) AS run_id, 'sql' AS stage, o_orderpriority AS job_name,
           'test' AS environment, 'manual' AS trigger_type,
           CASE WHEN o_orderstatus = 'F' THEN 'success' ELSE 'failed' END AS status,
           o_orderdate AS started_at,
           CASE WHEN o_orderstatus <> 'P' THEN o_orderdate + INTERVAL 90 SECOND END AS completed_at,
           o_custkey AS records_read,
           CASE WHEN o_orderstatus = 'F' THEN o_custkey END AS records_written,
           CAST(NULL AS BIGINT) AS files_written, o_totalprice AS price,
           CASE WHEN o_orderstatus = 'O' THEN 'SQL_FAILED'
                WHEN o_orderstatus = 'P' THEN 'Read_Timeout' END AS error_code
    FROM orders
"""
AUDIT = AUDIT_SQL.format(text="VARCHAR")


def audit_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "orders").createOrReplaceTempView("orders")
    rows = spark.sql(AUDIT_SQL.format(text="STRING"))
    check = F.struct(
        F.lit("not_null").alias("check_name"),
        F.when(F.col("status") == "success", "pass").otherwise("fail").alias("status"),
    )
    return rows.withColumns(
        {"extra": F.create_map(F.lit("Total Price"), "price"), "validations": F.array(check)}
    )


@suite.query(f"""
    WITH a AS ({AUDIT}), points AS (
        SELECT run_id, 'run_duration_seconds' AS metric_name, 'gauge' AS metric_type,
               epoch(completed_at - started_at) AS value, job_name, status,
               CAST(NULL AS VARCHAR) AS check_name FROM a
        UNION ALL SELECT run_id, 'records_read_total', 'counter', records_read, job_name, status, NULL FROM a
        UNION ALL SELECT run_id, 'records_written_total', 'counter', records_written, job_name,
                         status, NULL FROM a
        UNION ALL SELECT run_id, 'run_status', 'gauge', CASE WHEN status = 'success' THEN 1 ELSE 0 END,
                         job_name, status, NULL FROM a
        UNION ALL SELECT run_id, 'extra_total_price', 'gauge', price, job_name, status, NULL FROM a
        UNION ALL SELECT run_id, 'validation_result', 'counter', 1, job_name, status, 'not_null' FROM a)
    SELECT run_id, metric_name, metric_type, CAST(value AS DOUBLE) AS value, job_name, status, check_name
    FROM points WHERE value IS NOT NULL
""")
def run_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = telemetry.run_metrics(audit_rows(spark, sf_dir))
    return points.select(
        "run_id", "metric_name", "metric_type", "value",
        *[F.col("labels")[name].alias(name) for name in ("job_name", "status", "check_name")],
    )


@suite.query(f"""
    SELECT run_id, CASE WHEN error_code = 'Read_Timeout' THEN 'warning' ELSE 'critical' END AS severity,
           error_code
    FROM ({AUDIT}) WHERE status <> 'success'
""")
def run_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = telemetry.alerts(audit_rows(spark, sf_dir))
    return found.select("run_id", "severity", F.col("labels")["error_code"].alias("error_code"))


@suite.query("""
    SELECT date_trunc('day', ts) AS window_start, event_type, count(*) AS n
    FROM events GROUP BY ALL
""")
def stream_event_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily counts of a stream over event files: closed days as emitted, open ones from the state."""
    source, out, checkpoint = (scratch(spark, f"stream-{part}") for part in ("in", "out", "state"))
    events = table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    for arrived in thirds_of_january(events):
        arrived.write.mode("append").parquet(source)
        counts = windows.closing_counts(
            batches.read_files(spark, source, events.schema), "ts", "1 day", ["event_type"], "2 days"
        )
        batches.run_available(counts, batches.batch_table(out), checkpoint)
    closed = spark.read.parquet(out).drop(batches.BATCH)
    found = closed.unionByName(windows.open_windows(spark, checkpoint, ["event_type"]))
    return found.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "n")


def third_of_january(time: str = "ts"):
    """0, 1 or 2: events of the tables lie in January 2024; those of other times count to the ends."""
    days = F.date_diff(F.col(time).cast("date"), F.lit(date(2024, 1, 1)))
    return F.greatest(F.lit(0), F.least(F.lit(2), F.floor(days / 10))).cast("int")


def thirds_of_january(events: DataFrame) -> list[DataFrame]:
    return [events.where(third_of_january() == n) for n in range(3)]


@suite.query("""
    SELECT event_type AS topic, count(*) AS messages, max(event_id) + 1 AS next_offset
    FROM events GROUP BY 1
""")
def stream_offsets_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs with one checkpoint: the second reads only what arrived in between."""
    source, out = scratch(spark, "stream-in"), scratch(spark, "stream-out")
    checkpoint = scratch(spark, "stream-state")
    events = table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    early = F.col("ts") < literal(datetime(2024, 1, 16), T.TimestampNTZType())
    for arrived in (events.filter(early), events.filter(~early)):
        arrived.write.mode("append").parquet(source)
        stream = batches.read_files(spark, source, events.schema, max_files=4)
        batches.run_available(stream, batches.batch_table(out), checkpoint)
    stored = spark.read.parquet(out)
    return stored.groupBy(F.col("event_type").alias("topic")).agg(
        F.count(F.lit(1)).alias("messages"), (F.max("event_id") + 1).alias("next_offset")
    )


@suite.query("""
    SELECT event_id, event_type, value, strftime(ts, '%Y-%m-%d') AS event_day FROM events
""")
def stream_late_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late events and replayed ones land in their event-day partition exactly once."""
    source, out = scratch(spark, "stream-in"), scratch(spark, "stream-out")
    events = table(spark, sf_dir, "events").select(
        "event_id", "event_type", "value", F.date_format("ts", "yyyy-MM-dd").alias("event_day")
    )
    checkpoint = scratch(spark, "stream-state")
    late = F.col("event_type") == "error"
    sink = batches.upsert_table(out, events.schema, ["event_id"], ["event_day"])
    for arrived in (events.filter(~late), events.filter(late | (F.col("event_type") == "view"))):
        arrived.write.mode("append").parquet(source)
        batches.run_available(batches.read_files(spark, source, events.schema), sink, checkpoint)
    return loads.read_table(spark, out, events.schema)


ARRIVALS = """
    placed AS (
        SELECT *, greatest(0, least(2, date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) // 10)) AS third FROM events),
    arrivals AS (
        SELECT *, CASE WHEN event_id % 50 = 0 THEN least(2, third + 1) ELSE third END AS arrival FROM placed),
    marked AS (
        SELECT a.*, (SELECT max(e.ts) FROM arrivals e WHERE e.arrival < a.arrival) - INTERVAL 2 DAY AS mark
        FROM arrivals a)
"""


@suite.query(f"""
    WITH {ARRIVALS}, judged AS (
        SELECT *, coalesce(ts < mark, false) AS late,
            date_trunc('day', ts) + INTERVAL 1 DAY <= max(ts) FILTER (NOT coalesce(ts < mark, false)) OVER ()
                - INTERVAL 2 DAY AS closed
        FROM marked)
    SELECT CASE WHEN late THEN 'late' WHEN closed THEN 'closed' ELSE 'open' END AS kind,
           date_trunc('day', ts) AS day, event_type, count(*) AS n
    FROM judged GROUP BY ALL
""")
def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily counts of what came in time, closed and open, and counts of the side table of late rows.

    One event in fifty arrives ten days late, two are allowed.
    """
    source, routed, out, route_state, state = (scratch(spark, "stream-late") for _ in range(5))
    events = table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    third = third_of_january()
    arrival = F.when(F.col("event_id") % 50 == 0, F.least(F.lit(2), third + 1)).otherwise(third)
    sink = windows.route_late_rows(routed, "ts", "2 days")
    for n in range(3):
        events.where(arrival == n).write.mode("append").parquet(source)
        batches.run_available(batches.read_files(spark, source, events.schema), sink, route_state)
        rows = windows.punctual_rows(spark, routed, events.schema, "ts")
        counts = windows.closing_counts(rows, "ts", "1 day", ["event_type"], "2 days")
        batches.run_available(counts, batches.batch_table(out), state)
    late = windows.late_rows(spark, routed, events.schema, "ts")
    late = late.groupBy(F.date_trunc("day", "ts").alias("window_start"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    kinds = {
        "closed": spark.read.parquet(out), "open": windows.open_windows(spark, state, ["event_type"]), "late": late,
    }
    parts = [
        df.select(F.lit(kind).alias("kind"), F.col("window_start").cast("timestamp_ntz").alias("day"), "event_type", "n")
        for kind, df in kinds.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@suite.query("""
    WITH steps AS (
        SELECT user_id, ts, CASE WHEN ts < lag(ts) OVER w + INTERVAL 6 HOUR THEN 0 ELSE 1 END AS opens
        FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
    numbered AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS session FROM steps)
    SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 6 HOUR AS session_end, count(*) AS n
    FROM numbered GROUP BY user_id, session
    HAVING max(ts) + INTERVAL 6 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 1 DAY
""")
def stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of users (six hours apart) that have closed, over three runs of a stream."""
    source, out, state = (scratch(spark, "stream-sessions") for _ in range(3))
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id")
    for arrived in thirds_of_january(events):
        arrived.write.mode("append").parquet(source)
        stream = batches.read_files(spark, source, events.schema)
        sessions = windows.closing_sessions(stream, "ts", "6 hours", ["user_id"], "1 day")
        batches.run_available(sessions, batches.batch_table(out), state)
    times = {c: F.col(c).cast("timestamp_ntz") for c in ("session_start", "session_end")}
    return spark.read.parquet(out).drop(batches.BATCH).withColumns(times)


@suite.query("SELECT event_id, event_type FROM events")
def stream_first_occurrences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of the events comes twice in one run and again in the next; each is kept once."""
    source, out, state = (scratch(spark, "stream-first") for _ in range(3))
    events = table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    again = None
    for arrived in thirds_of_january(events):
        repeated = arrived.where("event_id % 10 = 3")
        files = arrived.unionByName(repeated)
        (files.unionByName(again) if again else files).write.mode("append").parquet(source)
        again = repeated
        stream = batches.read_files(spark, source, events.schema)
        first = windows.first_occurrences(stream, ["event_id"], "ts", "15 days")
        batches.run_available(first, batches.batch_table(out), state)
    return spark.read.parquet(out).select("event_id", "event_type")
