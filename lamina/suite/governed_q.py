"""Contracts, refusals and removals: what is compared, refused or deleted in stored tables."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.operators import contracts, export, loads, maintenance
from lamina.operators.contracts import ColumnContract
from lamina.operators.export import Publish
from lamina.session import scratch
from lamina.suite import Suite, table

suite = Suite()

#: The columns of orders as a contract names their types.
DECLARED = """
    SELECT column_name, CASE column_type WHEN 'VARCHAR' THEN 'STRING' WHEN 'TIMESTAMP' THEN 'TIMESTAMP_NTZ' ELSE column_type END AS type
    FROM (DESCRIBE orders)
"""

#: What the changed table has in their place: a key as text, no priority, a new column.
STORED = f"""
    SELECT column_name, CASE column_name WHEN 'o_custkey' THEN 'STRING' ELSE type END AS type
    FROM ({DECLARED}) WHERE column_name <> 'o_orderpriority'
    UNION ALL SELECT 'discount', 'DECIMAL(4,2)'
"""

DIFFERENCES = f"""
    SELECT coalesce(d.column_name, s.column_name) AS column_name,
           CASE WHEN d.type IS NULL THEN 'added' WHEN s.type IS NULL THEN 'removed' ELSE 'changed' END AS status,
           CASE WHEN s.type IS NOT NULL THEN d.type END AS expected_type, CASE WHEN d.type IS NOT NULL THEN s.type END AS actual_type
    FROM ({DECLARED}) d FULL JOIN ({STORED}) s ON d.column_name = s.column_name WHERE d.type IS DISTINCT FROM s.type
"""


def orders_contract(spark: SparkSession, sf_dir: str) -> list[ColumnContract]:
    schema = table(spark, sf_dir, "orders").schema
    return [ColumnContract(f.name, contracts.contract_type(f.dataType)) for f in schema.fields]


def changed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a later run stored them, read back from the files."""
    path = scratch(spark, "contract")
    rows = table(spark, sf_dir, "orders").withColumn("o_custkey", F.col("o_custkey").cast("string"))
    rows = rows.drop("o_orderpriority").withColumn("discount", F.lit("0.05").cast("decimal(4,2)"))
    loads.load(rows, path)
    return spark.read.parquet(path)


@suite.query(DIFFERENCES)
def contract_schema_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract of the given orders against the schema of a changed stored table."""
    stored = changed_orders(spark, sf_dir).schema
    found = contracts.compare_columns(spark, orders_contract(spark, sf_dir), stored, check_nullable=False)
    return found.select("column_name", "status", "expected_type", "actual_type")


@suite.query(f"""
    WITH found AS (SELECT count(*) AS n, string_agg(column_name, ',' ORDER BY column_name) AS names FROM ({DIFFERENCES}))
    SELECT mode, version, CASE WHEN mode = 'off' OR version = 'given' THEN 'published' WHEN mode = 'strict' THEN 'refused'
               ELSE 'published, ' || n || ' differences: ' || names END AS outcome,
           CASE WHEN mode = 'strict' AND version = 'changed' THEN 0 ELSE (SELECT count(*) FROM orders) END AS rows
    FROM found, (VALUES ('strict'), ('warn'), ('off')) m(mode), (VALUES ('given'), ('changed')) v(version)
""")
def contract_enforcement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load of the given and of changed orders under each mode: what is published, and how much."""
    declared = orders_contract(spark, sf_dir)
    versions = {"given": table(spark, sf_dir, "orders"), "changed": changed_orders(spark, sf_dir)}
    outcomes = []
    for mode in contracts.MODES:
        for version, df in versions.items():
            path, rows = scratch(spark, "enforced"), 0
            try:
                warnings = contracts.enforce(declared, df.schema, mode=mode)
                rows, outcome = loads.load(df, path).rows_written, "published"
                for _, diff in warnings:
                    names = sorted([*diff.added, *diff.removed, *(c["column"] for c in diff.changed)])
                    outcome += f", {len(names)} differences: {','.join(names)}"
            except contracts.ContractViolation:
                outcome = "refused"
            outcomes.append((mode, version, outcome, rows))
    return spark.createDataFrame(outcomes, "mode string, version string, outcome string, rows long")


@suite.query("""
    WITH n AS (SELECT count(*) AS n FROM orders)
    SELECT unnest(['at the ceiling', 'above the ceiling', 'a column is missing', 'no rows', 'no rows allowed', 'one file without a ceiling'])
               AS attempt,
           unnest([false, true, true, true, false, true]) AS refused,
           unnest([n, 0, 0, 0, 0, 0]) AS delivered
    FROM n
""")
def export_refusals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries that keep and break each rule, and the rows that are found delivered afterwards."""
    root = scratch(spark, "refusals")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    ceiling = rows.count()
    attempts = {
        "at the ceiling": (rows, dict(max_rows=ceiling), {}),
        "above the ceiling": (rows, dict(max_rows=ceiling - 1), {}),
        "a column is missing": (rows, dict(required_columns=("o_custkey",)), {}),
        "no rows": (rows.where("o_orderkey < 0"), {}, {}),
        "no rows allowed": (rows.where("o_orderkey < 0"), dict(allow_empty=True), {}),
        "one file without a ceiling": (rows, dict(max_rows=None), dict(single_file=True)),
    }
    found = []
    for n, (attempt, (df, rules, options)) in enumerate(attempts.items()):
        spec, refused, delivered = Publish("sales", f"attempt_{n}", "jsonl", **rules), False, 0
        path = export.plan_paths(spec, root, "run-1")["run"]
        try:
            export.publish(df, spec, root, "run-1", **options)
        except export.ExportRefused:
            refused = True
        if export.storage.exists(spark, path):
            delivered = spark.read.schema(df.schema).json(path).count()
        found.append((attempt, refused, delivered))
    return spark.createDataFrame(found, "attempt string, refused boolean, delivered long")


def runs_of_orders(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """Orders written by twelve runs a day apart, and their manifests with the folders' paths."""
    path = scratch(spark, "runs")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_orderkey") % 12).cast("int").alias("run"))
    orders.write.partitionBy("run").parquet(path)
    written = F.date_add(F.lit("2024-01-01").cast("date"), F.col("run")).cast("timestamp_ntz")
    manifests = orders.select("run").distinct().select(
        F.lit("orders").alias("table_name"), (F.col("run") % 2).alias("slot"), F.col("run").cast("string").alias("run_id"),
        written.alias("written_at"), F.concat(F.lit(f"{path}/run="), "run").alias("path"),
    )
    return path, manifests


@suite.query("SELECT o_orderkey, CAST(o_orderkey % 12 AS INTEGER) AS run FROM orders WHERE o_orderkey % 12 >= 6")
def runs_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs older than a week go, but for the newest two of each slot; what the folder then holds."""
    path, manifests = runs_of_orders(spark, sf_dir)
    expired = maintenance.expired_runs(manifests, datetime(2024, 1, 14), ["table_name", "slot"], retain_last=2)
    maintenance.remove_runs(spark, expired)
    return spark.read.parquet(path)


@suite.query("SELECT o_orderkey, CAST(o_orderkey % 12 AS INTEGER) AS run FROM orders WHERE o_orderkey % 12 NOT IN (2, 7)")
def orphans_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that no manifest names go (those of two runs), as seen some days later."""
    path, manifests = runs_of_orders(spark, sf_dir)
    files = maintenance.list_files(spark, path)
    names = files.withColumn("run_id", F.regexp_extract("directory", "run=([0-9]+)$", 1))
    known = names.join(manifests.where("run_id not in ('2', '7')"), "run_id", "left_semi").select("path")
    # the files were written now, or just before
    orphans = maintenance.orphan_files(files, known, datetime.now() + timedelta(days=5))
    maintenance.remove_files(spark, orphans)
    return spark.read.parquet(path)
