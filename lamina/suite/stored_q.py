"""Stored tables changed in place: compaction, refreshes, moves, deletions; ordered and hashed deliveries."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lamina.operators import (
    contracts,
    export,
    governance,
    lineage,
    loads,
    maintenance,
    metrics,
    normalize,
    relational,
    sketches,
)
from lamina.operators.contracts import ColumnContract
from lamina.operators.export import Publish
from lamina.operators.metrics import Dimension, Metric
from lamina.plans import models
from lamina.session import scratch
from lamina.sources import eventlog, files, landing
from lamina.streaming import batches
from lamina.suite import Suite, table

suite = Suite()

BUCKET = "lpad(CAST(o_orderkey % 12 AS {text}), 3, '0')"


def text_partitions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    """Orders in partitions like 007: five files each below 006, two from there on."""
    path = scratch(spark, "small-files")
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.expr(BUCKET.format(text="STRING")).alias("bucket"), (F.col("o_orderkey") % 5).alias("turn")
    )
    rare = F.col("bucket") >= "006"
    rows = rows.withColumn("turn", F.when(rare, F.least("turn", F.lit(1))).otherwise(F.col("turn")))
    for turn in range(5):
        part = rows.filter(F.col("turn") == turn).drop("turn")
        part.repartition(1).write.mode("append").partitionBy("bucket").parquet(path)
    return rows.drop("turn"), path


@suite.query(f"""
    SELECT bucket, rows, total, CASE WHEN bucket < '006' THEN 1 ELSE files END AS files FROM (
        SELECT {BUCKET.format(text='VARCHAR')} AS bucket, count(*) AS rows, CAST(sum(o_orderkey) AS BIGINT) AS total,
               CAST(count(DISTINCT least(o_orderkey % 5, 1)) AS INTEGER) AS files FROM orders GROUP BY 1)
""")
def compact_text_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the partitions have too few small files to be rewritten; files are counted."""
    rows, path = text_partitions(spark, sf_dir)
    maintenance.compact(spark, path)
    stored = loads.read_table(spark, path, rows.schema).withColumn("file", F.col("_metadata.file_name"))
    return stored.groupBy("bucket").agg(
        F.count("*").alias("rows"), F.sum("o_orderkey").alias("total"),
        F.count_distinct("file").cast("int").alias("files"),
    )


@suite.query(f"""
    SELECT CAST(sum(files) AS BIGINT) AS files, count(*) FILTER (files >= 5) AS partitions_to_compact FROM (
        SELECT {BUCKET.format(text='VARCHAR')} AS bucket, count(DISTINCT CASE
                   WHEN {BUCKET.format(text='VARCHAR')} < '006' THEN o_orderkey % 5
                   ELSE least(o_orderkey % 5, 1) END) AS files
        FROM orders GROUP BY 1)
""")
def maintenance_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, path = text_partitions(spark, sf_dir)
    return maintenance.report(spark, [path]).select("files", "partitions_to_compact")


@suite.query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'P'")
def refresh_from_itself(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "refresh")
    loads.load(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), path)
    loads.load(spark.read.parquet(path).filter("o_orderstatus <> 'P'"), path)
    return spark.read.parquet(path)


MOVES = """
    SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN {moved} ELSE {kept} END AS part,
           CASE WHEN o_orderkey % 3 = 0 THEN 'moved' ELSE 'kept' END AS note FROM orders
"""


def moved_rows(spark: SparkSession, sf_dir: str, kept: str, moved: str) -> DataFrame:
    """Every third order moves to another partition, the batch replayed."""
    path = scratch(spark, "moves")
    orders = table(spark, sf_dir, "orders")
    rows = orders.select("o_orderkey", F.expr(kept).alias("part"), F.lit("kept").alias("note"))
    loads.load(rows, path, "partition_overwrite", ["part"])
    batch = orders.filter("o_orderkey % 3 = 0").select(
        "o_orderkey", F.expr(moved).alias("part"), F.lit("moved").alias("note")
    )
    for _ in range(2):
        loads.upsert_into(spark, path, rows.schema, batch, ["o_orderkey"], ["part"])
    return loads.read_table(spark, path, rows.schema)


@suite.query(MOVES.format(kept="o_orderkey % 2 = 0", moved="true"))
def upsert_moves_boolean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return moved_rows(spark, sf_dir, "o_orderkey % 2 = 0", "true")


@suite.query(MOVES.format(
    kept="date_trunc('year', CAST(o_orderdate AS DATE))::DATE", moved="DATE '2030-01-01'"
))
def upsert_moves_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return moved_rows(spark, sf_dir, "CAST(trunc(o_orderdate, 'year') AS DATE)", "DATE '2030-01-01'")


@suite.query(MOVES.format(
    kept="TIMESTAMP '2024-01-01 00:00:00.5' + (o_orderkey % 6) * INTERVAL 1 HOUR",
    moved="TIMESTAMP '2024-01-01 00:00:00.25'",
))
def upsert_moves_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours = "make_dt_interval(0, CAST(o_orderkey % 6 AS INT))"
    return moved_rows(
        spark, sf_dir, f"TIMESTAMP_NTZ '2024-01-01 00:00:00.5' + {hours}", "TIMESTAMP_NTZ '2024-01-01 00:00:00.25'"
    )


@suite.query("""
    SELECT event_id, event_type, value, strftime(ts, '%Y-%m-%d') AS event_day, 2 AS version FROM events
""")
def stream_repeated_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event comes twice in each batch, in two versions, and the batch is replayed."""
    source, out, state = (scratch(spark, f"repeat-{x}") for x in ("in", "out", "state"))
    events = table(spark, sf_dir, "events").select(
        "event_id", "event_type", "value", F.date_format("ts", "yyyy-MM-dd").alias("event_day")
    )
    versions = F.explode(F.array(F.lit(1), F.lit(2), F.lit(2))).alias("version")
    rows = events.select("*", versions)
    sink = batches.upsert_table(out, rows.schema, ["event_id"], ["event_day"], ["version"])
    for _ in range(2):
        rows.write.mode("append").parquet(source)
        batches.run_available(batches.read_files(spark, source, rows.schema), sink, state)
    return loads.read_table(spark, out, rows.schema)


def dated_orders(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    path = scratch(spark, "dated")
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.trunc("o_orderdate", "year").alias("order_year"),
        F.to_date("o_orderdate").alias("order_date"),
    )
    loads.load(rows, path, "partition_overwrite", ["order_year"])
    return rows, path


@suite.query("""
    SELECT o_orderkey, o_custkey, date_trunc('year', o_orderdate)::DATE AS order_year,
           CAST(o_orderdate AS DATE) AS order_date FROM orders
    WHERE NOT CAST(o_orderdate AS DATE) < DATE '2001-08-01' - INTERVAL 1000 DAY
""")
def retention_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, path = dated_orders(spark, sf_dir)
    governance.apply_retention(spark, path, rows.schema, "order_date", 1000, date(2001, 8, 1), ["order_year"])
    return loads.read_table(spark, path, rows.schema)


@suite.query("""
    SELECT o_orderkey, o_custkey, date_trunc('year', o_orderdate)::DATE AS order_year,
           CAST(o_orderdate AS DATE) AS order_date FROM orders
    WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)
""")
def erasure_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, path = dated_orders(spark, sf_dir)
    ids = table(spark, sf_dir, "customer").filter("c_acctbal < 0").select("c_custkey")
    governance.apply_erasure(spark, path, rows.schema, "o_custkey", ids, ["order_year"])
    return loads.read_table(spark, path, rows.schema)


def noted_orders(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    """Stored orders by year with a map column, as flattened documents have them."""
    path = scratch(spark, "noted")
    notes = F.create_map(F.lit("status"), F.col("o_orderstatus"), F.lit("priority"), F.col("o_orderpriority"))
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("order_date"), notes.alias("notes"),
        F.year("o_orderdate").alias("order_year"),
    )
    loads.load(rows, path, "partition_overwrite", ["order_year"])
    return rows, path


@suite.query("""
    SELECT o_orderkey, o_orderpriority AS priority FROM orders
    WHERE NOT CAST(o_orderdate AS DATE) < DATE '2001-08-01' - INTERVAL 900 DAY
      AND NOT (o_orderstatus = 'P' AND year(o_orderdate) = 2000)
""")
def retention_with_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retention, then an erasure by conditions, on a stored table with a map column."""
    rows, path = noted_orders(spark, sf_dir)
    governance.apply_retention(spark, path, rows.schema, "order_date", 900, date(2001, 8, 1), ["order_year"])
    partly = F.col("notes")["status"] == "P"
    governance.delete_where(spark, path, rows.schema, partly & (F.col("order_year") == 2000), ["order_year"])
    return loads.read_table(spark, path, rows.schema).select("o_orderkey", F.col("notes")["priority"].alias("priority"))


@suite.query("""
    WITH gone AS (SELECT c_custkey FROM customer WHERE c_acctbal < 0),
    gone_orders AS (SELECT o_orderkey FROM orders WHERE o_custkey IN (FROM gone))
    SELECT 'customer' AS name, c_custkey AS id, CAST(0 AS INTEGER) AS line FROM customer WHERE c_acctbal >= 0
    UNION ALL SELECT 'orders', o_orderkey, 0 FROM orders WHERE o_custkey NOT IN (FROM gone)
    UNION ALL SELECT 'lineitem', l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey NOT IN (FROM gone_orders)
    UNION ALL SELECT 'deleted customer', (SELECT count(*) FROM gone), 0
    UNION ALL SELECT 'deleted orders', (SELECT count(*) FROM gone_orders), 0
    UNION ALL SELECT 'deleted lineitem', (SELECT count(*) FROM lineitem WHERE l_orderkey IN (FROM gone_orders)), 0
""")
def erasure_cascade_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers are deleted from their table, with their orders (which hold maps) and the orders' lines."""
    orders, orders_path = noted_orders(spark, sf_dir)
    tables = {"orders": governance.StoredTable(orders_path, orders.schema, ("order_year",))}
    columns = {"customer": ["c_custkey", "c_acctbal"], "lineitem": ["l_orderkey", "l_linenumber"]}
    for name, names in columns.items():
        rows, path = table(spark, sf_dir, name).select(*names), scratch(spark, name)
        loads.load(rows, path)
        tables[name] = governance.StoredTable(path, rows.schema)
    ids = table(spark, sf_dir, "customer").filter("c_acctbal < 0").select("c_custkey")
    links = [("orders", "o_custkey", "customer", "c_custkey"), ("lineitem", "l_orderkey", "orders", "o_orderkey")]
    counts = governance.erase_stored_tree(spark, tables, links, "customer", "c_custkey", ids)
    found = spark.createDataFrame([(f"deleted {name}", n, 0) for name, n in counts.items()], "name string, id long, line int")
    ids_of = {"customer": ("c_custkey", F.lit(0)), "orders": ("o_orderkey", F.lit(0)), "lineitem": ("l_orderkey", F.col("l_linenumber"))}
    for name, (key, line) in ids_of.items():
        left = loads.read_table(spark, tables[name].path, tables[name].schema)
        found = found.unionByName(left.select(F.lit(name).alias("name"), F.col(key).alias("id"), line.alias("line")))
    return found


@suite.query("""
    SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey NOT IN (
        SELECT o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment = 'BUILDING')
""")
def erasure_two_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers are erased, with their orders and the orders' lines."""
    tables = {name: table(spark, sf_dir, name) for name in ("customer", "orders", "lineitem")}
    ids = tables["customer"].filter("c_mktsegment = 'BUILDING'").select("c_custkey")
    links = [("orders", "o_custkey", "customer", "c_custkey"), ("lineitem", "l_orderkey", "orders", "o_orderkey")]
    left = governance.erase_tree(tables, links, "customer", "c_custkey", ids)
    return left["lineitem"].select("l_orderkey", "l_linenumber")


@suite.query("""
    SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS place FROM orders
""")
def ordered_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows' places in a delivery of several ordered parts, read back from the files."""
    root = scratch(spark, "export")
    spec = Publish("sales", "ordered", "jsonl", order_by=("o_totalprice", "o_orderkey"))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    export.publish(rows.repartition(6), spec, root, "run-1")
    path = export.plan_paths(spec, root, "run-1")["run"]
    lines = spark.read.schema(rows.schema).json(path).select(
        "o_orderkey", F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("line")
    )
    counts = lines.groupBy("file").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(W.orderBy("file").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    placed = lines.withColumn("row", F.row_number().over(W.partitionBy("file").orderBy("line")))
    counts = counts.withColumn("before", before)
    return placed.join(counts, "file").select("o_orderkey", (F.col("before") + F.col("row")).alias("place"))


@suite.query("""
    SELECT sha256('n_nationkey,n_name' || chr(10) ||
        string_agg(n_nationkey || ',' || n_name, chr(10) ORDER BY n_nationkey) || chr(10)) AS sha256,
        count(*) AS total_rows FROM nation
""")
def export_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = Publish("geo", "nations", "csv", ("n_nationkey", "n_name"), max_rows=100, order_by=("n_nationkey",))
    found = export.publish(table(spark, sf_dir, "nation"), spec, scratch(spark, "export"), "r", single_file=True)
    return found.select("sha256", F.col("total_rows").cast("bigint").alias("total_rows"))


@suite.query("""
    SELECT topic, partition, "offset" FROM (
        SELECT *, row_number() OVER (PARTITION BY topic, partition ORDER BY "offset") AS rn FROM (
            SELECT nullif(event_type, 'error') AS topic, nullif(user_id % 3, 2)::INTEGER AS partition,
                   event_id AS "offset" FROM events))
    WHERE rn <= 200
""")
def event_log_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null topics and partitions, blocks of 256 offsets, and a cap that cuts within one."""
    log = table(spark, sf_dir, "events").select(
        F.nullif("event_type", F.lit("error")).alias("topic"),
        F.nullif((F.col("user_id") % 3).cast("int"), F.lit(2)).alias("partition"),
        F.col("event_id").alias("offset"),
    )
    return eventlog.first_messages(log, 200, width=256)


@suite.query("""
    SELECT 'o_orderkey' AS column_name, 0::BIGINT AS type_violations, 0::BIGINT AS null_violations
    UNION ALL SELECT 'o_region', 0, count(*) FROM orders
""")
def contract_absent_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A required column that the table lacks counts as null in every row."""
    declared = [ColumnContract("o_orderkey", "bigint", False), ColumnContract("o_region", "string", False)]
    return contracts.conformance(table(spark, sf_dir, "orders"), declared)


@suite.query("""
    SELECT CASE WHEN o_orderstatus <> 'P' THEN o_orderkey END AS o_orderkey,
           CASE WHEN o_orderstatus = 'P' THEN '{"o_orderkey": ' || o_orderkey END AS broken FROM orders
""")
def json_lines_broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines without their closing brace are kept whole, the others are parsed."""
    path = scratch(spark, "lines")
    text = F.concat(F.lit('{"o_orderkey": '), F.col("o_orderkey"),
                    F.when(F.col("o_orderstatus") == "P", "").otherwise("}"))
    table(spark, sf_dir, "orders").select(text.alias("value")).write.text(path)
    return files.scan_json_lines(spark, path, "o_orderkey bigint", broken="broken")


@suite.query("""
    SELECT c_custkey, CAST(c_nationkey AS VARCHAR) AS data_run, 'run-7' AS folder_run FROM customer
""")
def level2_clashing_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document field called run_id stays apart from the folder's run."""
    root = scratch(spark, "level2")
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").cast("string").alias("run_id"))
    where = ("crm", "customers", "customers")
    landing.write_level2(rows, root, source=where[0], entity=where[1], table=where[2], mapping_version="m1", run_id="run-7")
    found = landing.read_level2(spark, root, *where)
    return found.select(
        "c_custkey", F.col("data__run_id").alias("data_run"), F.col("run_id").alias("folder_run")
    )


@suite.query("""
    SELECT count(*) AS rows, count(DISTINCT (a, b)) AS keys FROM (
        SELECT nullif(o_orderpriority, '5-LOW') AS a, nullif(CAST(o_orderkey // 4 AS VARCHAR), '7') AS b FROM orders)
""")
def document_keys_with_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many keys as distinct pairs, null parts included."""
    a = F.nullif("o_orderpriority", F.lit("5-LOW"))
    b = F.nullif(F.floor(F.col("o_orderkey") / 4).cast("string"), F.lit("7"))
    key = relational.document_key(a, b)
    return table(spark, sf_dir, "orders").agg(F.count("*").alias("rows"), F.count_distinct(key).alias("keys"))


@suite.query("""
    SELECT event_type, ts, round(sum(sum(value)) OVER (
        PARTITION BY event_type ORDER BY ts ROWS 4 PRECEDING), 2) AS last_five
    FROM events GROUP BY event_type, ts
""")
def metric_rolling_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rolling total over a fine-grained time dimension."""
    spec = Metric(
        "app", "last_five", "level4.app.events.value", "cumulative_rolling",
        (Dimension("event_type"), Dimension("ts", True)), rolling_periods=5,
    )
    found = metrics.compute(table(spark, sf_dir, "events"), spec)
    return found.withColumn("last_five", F.round("last_five", 2))


@suite.query("""
    SELECT o_custkey, o_orderkey, CAST(sum(o_totalprice_cents) OVER (
        PARTITION BY o_custkey ORDER BY o_orderkey) AS BIGINT) AS running
    FROM (SELECT o_custkey, o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS o_totalprice_cents FROM orders)
""")
def metric_cumulative_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A running total over a numeric time dimension."""
    rows = table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey", F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents")
    )
    spec = Metric(
        "sales", "running", "level4.sales.orders.cents", "cumulative_rolling",
        (Dimension("o_custkey"), Dimension("o_orderkey", True)),
    )
    return metrics.compute(rows, spec).select("o_custkey", "o_orderkey", "running")


MODEL = {
    "stage": "level3", "domain": "sales", "name": "orders", "target": {"table_name": "orders_out"},
    "sources": [{"logical_name": "raw_orders", "source_name": "shop", "entity_name": "orders"}],
    "quality": {"policy": "best_effort", "not_null_columns": ["status"], "unique_columns": ["customer"]},
    "governance": {"classification": "internal", "columns": [
        {"name": "customer", "classification": "confidential", "masking": "hash_sha256"}]},
}
MODEL_SQL = "SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status, CAST(o_custkey AS STRING) AS customer FROM raw_orders"


def audited_run(spark: SparkSession, sf_dir: str):
    path, model = scratch(spark, "audited"), models.model_from_dict(MODEL, MODEL_SQL)
    runner = models.Runner(
        spark, f"{path}/warehouse", models.token_context("test", "run-1"),
        lambda ref: table(spark, sf_dir, "orders"), f"{path}/quarantine", f"{path}/audit",
    )
    runner.run([model])
    return runner, model, path


@suite.query("""
    SELECT 'not_null:status' AS check_name, o_orderkey FROM orders WHERE o_orderstatus = 'P'
    UNION ALL
    SELECT 'unique:customer', o_orderkey FROM (
        SELECT o_orderkey, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders) WHERE n > 1
""")
def model_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A best-effort model loads everything and leaves its violating rows in quarantine."""
    _, _, path = audited_run(spark, sf_dir)
    kept = spark.read.schema("record string, check_name string").json(f"{path}/quarantine")
    key = F.get_json_object("record", "$.o_orderkey").cast("bigint").alias("o_orderkey")
    return kept.select("check_name", key)


@suite.query("""
    SELECT 'run-1' AS run_id, 'level3.sales.orders' AS job_name, 'success' AS status,
           count(*) AS records_written, 2 AS failed_checks FROM orders
""")
def model_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, _, path = audited_run(spark, sf_dir)
    failed = F.size(F.filter("validations", lambda v: v["status"] == "fail")).alias("failed_checks")
    return spark.read.parquet(f"{path}/audit").select("run_id", "job_name", "status", "records_written", failed)


@suite.query("""
    SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status, sha256(CAST(o_custkey AS VARCHAR)) AS customer FROM orders
""")
def model_masked_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classification and masking come from the model's manifest."""
    runner, model, _ = audited_run(spark, sf_dir)
    found = runner.masked(model)
    return found.select("o_orderkey", "status", "customer")


@suite.query("""
    SELECT 'raw_orders' AS source, c AS source_column, 'orders_out' AS target, t AS target_column
    FROM (VALUES ('o_orderkey', 'o_orderkey'), ('o_orderstatus', 'status'), ('o_custkey', 'customer')) v(c, t)
    WHERE (SELECT count(*) FROM orders) > 0
""")
def model_column_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column edges from the lineage events of a model run."""
    runner, _, _ = audited_run(spark, sf_dir)
    edges = lineage.column_edges(runner.lineage_events("2024-01-01T00:00:00Z"))
    dataset = F.when(F.col("source") == "shop.orders", "raw_orders").otherwise(F.col("source"))
    return edges.withColumn("source", dataset)


@suite.query("""
    SELECT 'shop' AS source_name, strftime(o_orderdate, '%Y-%m') AS business_date, count(*) AS rows
    FROM orders GROUP BY ALL
""")
def model_default_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A level-3 overwrite without declared partitions is stored by source and business date."""
    spec = {"stage": "level3", "domain": "sales", "name": "dated", "target": {"table_name": "dated"},
            "load_mode": "partition_overwrite",
            "sources": [{"logical_name": "raw_orders", "source_name": "shop", "entity_name": "orders"}]}
    sql = ("SELECT o_orderkey, 'shop' AS source_name, date_format(o_orderdate, 'yyyy-MM') AS business_date "
           "FROM raw_orders")  # fmt: skip
    path = scratch(spark, "default-parts")
    runner = models.Runner(
        spark, path, models.token_context("test", "run-1"), lambda ref: table(spark, sf_dir, "orders")
    )
    runner.run([models.model_from_dict(spec, sql)])
    stored = spark.read.option("recursiveFileLookup", True).parquet(f"{path}/level3/dated")
    where = F.regexp_extract(F.col("_metadata.file_path"), "/source_name=([^/]+)/business_date=([^/]+)/", 1)
    month = F.regexp_extract(F.col("_metadata.file_path"), "/source_name=([^/]+)/business_date=([^/]+)/", 2)
    return stored.groupBy(where.alias("source_name"), month.alias("business_date")).agg(F.count("*").alias("rows"))


@suite.query("SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, c_mktsegment AS segment FROM customer")
def csv_to_level2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A CSV entity is landed, flattened and written as a level-2 run."""
    root = scratch(spark, "csv-level2")
    rows = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )
    landing.land(rows, f"{root}/landed", "csv")
    docs = files.scan_csv(spark, f"{root}/landed")
    normalize.normalize(
        docs, root, source="crm", entity="customers", row_id=relational.document_key(F.col("id")),
        run_id="run-1", ingest_date="2024-01-02",
    )
    return landing.read_level2(spark, root, "crm", "customers", "customers").select("id", "name", "segment")


@suite.query("""
    SELECT o_orderpriority AS k, o_orderkey AS position, o_totalprice AS value FROM orders
""")
def map_and_nested_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maps stay one column, inner arrays stay whole; both read back from the flattened tables."""
    orders = table(spark, sf_dir, "orders")
    # a document holds a bounded range of keys, however large the table
    docs = orders.groupBy("o_orderpriority", F.expr("o_orderkey div 50").alias("block")).agg(
        F.map_from_entries(F.array_agg(F.struct("o_orderkey", "o_totalprice"))).alias("prices"),
        F.array_agg(F.array("o_orderkey", "o_custkey")).alias("pairs"),
    )
    tables = relational.relationalize(docs, "priorities", relational.document_key(F.col("o_orderpriority"), F.col("block")))
    root, pairs = tables["priorities"], tables["priorities__pairs"]
    joined = pairs.join(root, pairs["_parent_row_id"] == root["_row_id"])
    key = F.element_at("value", 1)
    return joined.select(
        F.col("o_orderpriority").alias("k"), key.alias("position"), F.element_at("prices", key).alias("value")
    )


DELIVERY = {
    "name": "big_days", "domain": "sales", "source": {"dataset": "daily", "selection_mode": "query"},
    "delivery": {"output_format": "csv", "path_template": "{domain}/{window_label}/{publish_name}.{output_extension}"},
    "columns": ["order_date", "orders"], "validation": {"required_columns": ["orders"]},
}


@suite.query("""
    SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_date, CAST(count(*) AS VARCHAR) AS orders
    FROM orders GROUP BY 1 HAVING count(*) >= 5
""")
def delivery_by_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A delivery defined by a manifest and a SELECT over its dataset."""
    spec = export.publish_from_dict(DELIVERY, "SELECT order_date, n AS orders, 1 AS more FROM daily WHERE n >= 5")
    days = table(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").alias("order_date")).agg(F.count("*").alias("n"))
    root = scratch(spark, "export")
    export.deliver(spark, spec, lambda name: days, root, "run-1", "all")
    return spark.read.csv(export.plan_paths(spec, root, "run-1", "all")["run"], header=True)


@suite.query("""
    SELECT c_mktsegment AS segment, strlen(string_agg(c_name, chr(10) ORDER BY c_custkey)) + 1 AS file_size_bytes,
           sha256(string_agg(c_name, chr(10) ORDER BY c_custkey) || chr(10)) AS content_hash
    FROM customer GROUP BY 1
""")
def landed_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes and hashes of landed files, one per segment, against those of the rows."""
    path = scratch(spark, "landed")
    rows = table(spark, sf_dir, "customer").repartition("c_mktsegment").sortWithinPartitions("c_mktsegment", "c_custkey")
    rows.select("c_name", "c_mktsegment").write.partitionBy("c_mktsegment").text(path)
    found = landing.landed_manifest(
        spark, path, run_id="run-1", source="crm", entity="customers", payload_format="txt"
    )
    segment = F.regexp_extract("data_path", "c_mktsegment=([^/]+)/", 1).alias("segment")
    return found.select(segment, "file_size_bytes", "content_hash")


@suite.query("""
    SELECT o_orderkey AS order_id, CASE WHEN year(o_orderdate) >= 1998 THEN o_orderpriority END AS priority FROM orders
""")
def schema_evolution_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Older files lack a column that later appends have."""
    path, orders = scratch(spark, "evolved"), table(spark, sf_dir, "orders")
    late = F.year("o_orderdate") >= 1998
    loads.load(orders.filter(~late).select(F.col("o_orderkey").alias("order_id")), path, "append")
    wide = orders.filter(late).select(F.col("o_orderkey").alias("order_id"), F.col("o_orderpriority").alias("priority"))
    loads.load(wide, path, "append")
    return spark.read.option("mergeSchema", True).parquet(path)


@suite.query("""
    SELECT o_orderpriority, quantile_disc(o_totalprice, 0.25) AS low, quantile_disc(o_totalprice, 0.5) AS middle,
           quantile_disc(o_totalprice, 0.9) AS high
    FROM orders GROUP BY 1
""")
def quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact quantiles from counted values in sorted ranges."""
    wanted = {"low": 0.25, "middle": 0.5, "high": 0.9}
    return sketches.exact_quantiles(table(spark, sf_dir, "orders"), ["o_orderpriority"], "o_totalprice", wanted)


@suite.query("""
    SELECT run_id, mode, CAST(round(sum(o_totalprice), 2) AS DOUBLE) AS total, count(DISTINCT o_orderpriority) AS values
    FROM orders, (VALUES ('r1', 'table'), ('r2', 'view')) runs(run_id, mode) GROUP BY ALL
""")
def metric_audit_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs of one metric leave two audit rows."""
    path = scratch(spark, "metric-audit")
    spec = Metric("sales", "by_priority", "level4.sales.orders.o_totalprice", "sum", (Dimension("o_orderpriority"),))
    stats = metrics.audit_stats(table(spark, sf_dir, "orders"), spec)
    for run, mode in (("r1", "table"), ("r2", "view")):
        metrics.write_audit(stats, path, mode, run, "2024-01-01T00:00:00Z")
    found = spark.read.parquet(path)
    return found.select("run_id", "mode", F.round("total_sum", 2).alias("total"), F.col("non_null_count").alias("values"))
