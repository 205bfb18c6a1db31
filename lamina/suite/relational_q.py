"""Nested documents to relational tables, and raw file scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.operators import relational
from lamina.operators.normalize import normalize
from lamina.sources import files, landing
from lamina.session import scratch
from lamina.suite import Suite, table

suite = Suite()


def nested_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text as a document of lines of words, built within the row."""
    lines = F.transform(
        F.split("text", "\n"),
        lambda line: F.struct(F.length(line).alias("size"), F.split(line, " ").alias("words")),
    )
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.struct("lang", F.struct("source", "n_chars").alias("origin")).alias("meta"),
        lines.alias("lines"),
    )


def flattened(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    docs = nested_documents(spark, sf_dir)
    return relational.relationalize(docs, "document", relational.document_key(F.col("doc_id")))


@suite.query("""
    SELECT substr(sha256(length(CAST(doc_id AS VARCHAR)) || ':' || CAST(doc_id AS VARCHAR)), 1, 32) AS _row_id, doc_id, lang AS meta__lang,
           source AS meta__origin__source, n_chars AS meta__origin__n_chars
    FROM documents
""")
def relationalize_root(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flattened(spark, sf_dir)["document"]


LINES = """
    SELECT doc_id, substr(sha256(length(CAST(doc_id AS VARCHAR)) || ':' || CAST(doc_id AS VARCHAR)), 1, 32) AS parent,
           unnest(string_split(text, chr(10))) AS line,
           unnest(range(len(string_split(text, chr(10))))) AS i
    FROM documents
"""


@suite.query(f"""
    SELECT parent || '/' || i AS _row_id, parent AS _parent_row_id,
           CAST(i AS INTEGER) AS _array_index, CAST(length(line) AS INTEGER) AS size
    FROM ({LINES})
""")
def relationalize_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flattened(spark, sf_dir)["document__lines"]


@suite.query(f"""
    SELECT parent || '/' || i || '/' || j AS _row_id, parent || '/' || i AS _parent_row_id,
           CAST(j AS INTEGER) AS _array_index, word AS value
    FROM (SELECT parent, i, unnest(string_split(line, ' ')) AS word,
                 unnest(range(len(string_split(line, ' ')))) AS j
          FROM ({LINES}))
""")
def relationalize_scalar_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flattened(spark, sf_dir)["document__words"]


@suite.query(f"""
    SELECT d.doc_id, d.lang, l.lines, l.longest
    FROM documents d JOIN (
        SELECT doc_id, count(*) AS lines, CAST(max(length(line)) AS INTEGER) AS longest
        FROM ({LINES}) GROUP BY doc_id) l ON l.doc_id = d.doc_id
""")
def relationalize_rejoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = flattened(spark, sf_dir)
    lines = tables["document__lines"].groupBy("_parent_row_id").agg(
        F.count(F.lit(1)).alias("lines"), F.max("size").alias("longest")
    )
    root = tables["document"]
    return root.join(lines, F.col("_row_id") == F.col("_parent_row_id")).select(
        "doc_id", F.col("meta__lang").alias("lang"), "lines", "longest"
    )


@suite.query("""
    SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
           o_orderstatus AS status, o_orderpriority AS priority,
           CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) AS amount
    FROM orders
""")
def csv_scan_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "csv")
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
        F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("amount"),
    )
    landing.land(orders, path, "csv")
    return files.scan_csv(spark, path)


@suite.query("""
    SELECT event_id, user_id, event_type, props,
           CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
    FROM events
""")
def jsonl_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "jsonl")
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "props")
    landing.land(events, path, "jsonl")
    schema = "event_id bigint, user_id bigint, event_type string, props string"
    return files.scan_json_lines(spark, path, schema).withColumn(
        "k", F.from_json("props", "k bigint").getField("k")
    )


@suite.query("""
    SELECT CAST(s_suppkey % 50 AS INTEGER) AS _position, s_suppkey AS id, s_name AS name,
           CAST(s_nationkey AS BIGINT) AS address__nation, s_acctbal AS address__balance
    FROM supplier
""")
def json_document_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files holding one JSON array of up to 50 suppliers each, read back with positions."""
    path = scratch(spark, "documents")
    item = F.struct(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
        F.struct(
            F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("balance")
        ).alias("address"),
    )
    payloads = (
        table(spark, sf_dir, "supplier")
        .groupBy(F.floor(F.col("s_suppkey") / 50).alias("page"))
        .agg(F.to_json(F.array_sort(F.collect_list(item))).alias("value"))
        .select("value")
    )
    payloads.write.option("maxRecordsPerFile", 1).text(path)
    docs = files.scan_documents(spark, path)
    key = relational.document_key(F.col(files.ARTIFACT), F.col(files.POSITION))
    flat = relational.relationalize(docs, "supplier", key)["supplier"]
    return flat.select(
        F.col("position").alias("_position"), "id", "name", "address__nation", "address__balance"
    )


@suite.query("""
    SELECT source_name, ingest_date, _run_id, c_custkey, c_mktsegment
    FROM (SELECT 'crm' AS source_name, '2024-01-02' AS ingest_date, 'run-1' AS _run_id, *
          FROM customer)
""")
def level2_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch(spark, "level2")
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    version = relational.mapping_version(relational.plan_tables("customer", rows.schema))
    part = relational.partition_values("ingest_date", {"ingest_date": "2024-01-02"})
    landing.write_level2(
        relational.with_lineage(rows, "crm", "2024-01-02", "run-1"), root,
        source="crm", entity="customer", table="customer", mapping_version=version,
        run_id="run-1", partition=part,
    )
    found = landing.read_level2(spark, root, "crm", "customer", "customer")
    return found.select("source_name", "ingest_date", "_run_id", "c_custkey", "c_mktsegment")


@suite.query("""
    SELECT mktsegment, count(*) AS files_rows FROM (
        SELECT c_mktsegment AS mktsegment FROM customer) GROUP BY mktsegment
""")
def raw_view_bypass(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "bypass")
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_mktsegment").alias("mktsegment")
    )
    landing.land(rows, path, "jsonl")
    files.expose_raw(spark, "raw_customer", path, "jsonl")
    return spark.sql(
        "SELECT mktsegment, count(*) AS files_rows FROM raw_customer GROUP BY mktsegment"
    )


@suite.query("""
    SELECT 'run-1' AS run_id, 'app' AS source_name, 'events' AS entity_name, true AS has_bytes,
           24 AS id_length, 64 AS hash_length
""")
def landed_artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest of a landed payload, reduced to what does not depend on file splits."""
    path = scratch(spark, "landed")
    landing.land(table(spark, sf_dir, "events"), path, "jsonl")
    rows = landing.landed_manifest(
        spark, path, run_id="run-1", source="app", entity="events", payload_format="jsonl"
    )
    return rows.groupBy("run_id", "source_name", "entity_name").agg(
        (F.sum("file_size_bytes") > 0).alias("has_bytes"),
        F.max(F.length("artifact_id")).alias("id_length"),
        F.max(F.length("content_hash")).alias("hash_length"),
    )


@suite.query(f"""
    SELECT 'document' AS table_name, 'run-1' AS _run_id, count(*) AS rows_stored FROM documents
    UNION ALL SELECT 'document__lines', 'run-1', count(*) FROM ({LINES})
    UNION ALL SELECT 'document__words', 'run-1', sum(len(string_split(line, ' ')))::BIGINT
              FROM ({LINES})
""")
def normalize_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All tables of a nested source written as one run and read back."""
    root = scratch(spark, "normalize")
    normalize(
        nested_documents(spark, sf_dir), root, source="crawl", entity="document",
        row_id=relational.document_key(F.col("doc_id")), run_id="run-1",
        ingest_date="2024-01-02", partition={"ingest_date": "2024-01-02"},
    )
    counts = [
        landing.read_level2(spark, root, "crawl", "document", name)
        .groupBy("_run_id").agg(F.count(F.lit(1)).alias("rows_stored"))
        .select(F.lit(name).alias("table_name"), "_run_id", "rows_stored")
        for name in ("document", "document__lines", "document__words")
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])
