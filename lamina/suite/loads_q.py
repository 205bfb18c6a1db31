"""Load modes, upserts, replays and schema evolution."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.operators import loads, relational
from lamina.session import scratch
from lamina.sources import landing
from lamina.suite import Suite, table

suite = Suite()

def month():
    return F.date_format("o_orderdate", "yyyy-MM")


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("amount"),
        month().alias("business_month"),
    )


@suite.query("""
    SELECT o_orderkey AS order_id, o_orderstatus AS status,
           CASE WHEN strftime(o_orderdate, '%Y') = '1997' THEN o_totalprice + 10
                ELSE o_totalprice END AS amount,
           strftime(o_orderdate, '%Y-%m') AS business_month
    FROM orders
""")
def partition_overwrite_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All months loaded, then the months of 1997 corrected twice; the others survive."""
    path, parts = scratch(spark, "overwrite"), ["business_month"]
    rows = sales(spark, sf_dir)
    loads.load(rows, path, "full_refresh", parts)
    fixed = rows.filter(F.col("business_month").startswith("1997")).withColumn(
        "amount", F.col("amount") + 10
    )
    for _ in range(2):
        loads.load(fixed, path, "partition_overwrite", parts)
    return loads.read_table(spark, path, rows.schema)


@suite.query("""
    SELECT o_orderkey AS order_id, o_orderstatus AS status, o_totalprice AS amount,
           strftime(o_orderdate, '%Y-%m') AS business_month
    FROM orders
""")
def late_arrival_repartition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders arrive days after their event date; two arrival batches, the second replayed."""
    path, parts = scratch(spark, "late"), ["business_month"]
    delay = F.length("o_orderpriority").cast("int")  # 5 to 15 days
    level2 = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("amount"), month().alias("business_month"),
        F.date_add("o_orderdate", delay).alias("ingest_date"),
    )
    early = F.col("ingest_date") < F.lit("1998-01-01").cast("date")
    loads.load(level2.filter(early).drop("ingest_date"), path, "partition_overwrite", parts)
    batch = level2.filter(~early)
    for _ in range(2):
        complete = loads.late_partitions(level2, batch, "business_month").drop("ingest_date")
        loads.load(complete, path, "partition_overwrite", parts)
    return loads.read_table(spark, path, level2.drop("ingest_date").schema)


@suite.query("""
    SELECT o_orderkey AS order_id, o_orderstatus AS status, o_totalprice AS amount,
           strftime(o_orderdate, '%Y-%m') AS business_month
    FROM orders
""")
def append_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, rows = scratch(spark, "append"), sales(spark, sf_dir)
    first = F.col("business_month") < "1998-07"
    loads.load(rows.filter(first), path, "append")
    loads.load(rows.filter(~first), path, "append")
    return loads.read_table(spark, path, rows.schema)


@suite.query("""
    SELECT 'shop' AS source_name, strftime(last_day(o_orderdate), '%Y-%m-%d') AS ingest_date,
           count(*) AS n, round(sum(o_totalprice), 2) AS total
    FROM orders GROUP BY 2
""")
def ingest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of a month arrive on its last day; the table is partitioned by arrival day."""
    path = scratch(spark, "snapshot")
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", F.lit("shop").alias("source_name"),
        F.date_format(F.last_day("o_orderdate"), "yyyy-MM-dd").alias("ingest_date"),
    )
    loads.load(rows, path, "full_refresh", ["source_name", "ingest_date"])
    stored = loads.read_table(spark, path, rows.schema)
    return stored.groupBy("source_name", "ingest_date").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


def merge_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders before 1999, and a delivery of those from 1998 on with corrected amounts."""
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
        F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("amount"),
        F.year("o_orderdate").cast("string").alias("business_year"),
    )
    target = rows.filter(F.col("business_year") < "1999")
    source = rows.filter(F.col("business_year") >= "1998").withColumn(
        "amount", F.when(F.col("status") == "F", F.col("amount") + 10).otherwise(F.col("amount") - 10)
    )
    return target, source


MERGED = """
    SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS status,
           CASE WHEN {changed} THEN CASE WHEN o_orderstatus = 'F' THEN o_totalprice + 10
                ELSE o_totalprice - 10 END ELSE o_totalprice END AS amount,
           strftime(o_orderdate, '%Y') AS business_year
    FROM orders WHERE {kept}
"""


@suite.query(MERGED.format(changed="year(o_orderdate) >= 1998", kept="true"))
def merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, source = merge_sides(spark, sf_dir)
    return loads.upsert(target, source, ["order_id"], target.columns)


@suite.query(MERGED.format(changed="year(o_orderdate) >= 1999", kept="true"))
def merge_insert_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, source = merge_sides(spark, sf_dir)
    return loads.upsert(target, source, ["order_id"], target.columns, update=False)


@suite.query(MERGED.format(
    changed="(year(o_orderdate) = 1998 AND o_orderstatus = 'F') OR year(o_orderdate) >= 1999",
    kept="year(o_orderdate) < 1999 OR o_orderstatus <> 'P'",
))
def merge_conditional(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, source = merge_sides(spark, sf_dir)
    return loads.upsert(
        target, source, ["order_id"], target.columns,
        matched_condition="s.amount > t.amount", not_matched_condition="s.status <> 'P'",
    )


@suite.query("""
    SELECT o_orderkey AS order_id, o_orderstatus AS status, o_totalprice AS amount,
           CASE WHEN year(o_orderdate) = 1998 THEN '1999'
                ELSE strftime(o_orderdate, '%Y') END AS business_year
    FROM orders
""")
def merge_partition_move(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upsert in place; all rows of 1998 move to 1999 and the old partition is vacated."""
    path, parts = scratch(spark, "move"), ["business_year"]
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("amount"),
        F.year("o_orderdate").cast("string").alias("business_year"),
    )
    loads.load(rows, path, "partition_overwrite", parts)
    moved = rows.filter(F.col("business_year") == "1998").withColumn(
        "business_year", F.lit("1999")
    )
    loads.upsert_into(spark, path, rows.schema, moved, ["order_id"], parts)
    return loads.read_table(spark, path, rows.schema)


@suite.query("""
    SELECT o_orderkey AS order_id,
           CASE WHEN year(o_orderdate) >= 1998 THEN o_totalprice + 5 ELSE o_totalprice END AS amount,
           CASE WHEN year(o_orderdate) >= 1998 THEN 'run-2' ELSE 'run-1' END AS _run_id
    FROM orders
""")
def replay_dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two landed runs of one entity, the second a replay with corrections; newest wins."""
    root = scratch(spark, "replay")
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_totalprice").alias("amount"),
        F.year("o_orderdate").alias("y"),
    )
    version = relational.mapping_version(relational.plan_tables("orders", rows.schema))
    replay = rows.filter("y >= 1998").withColumn("amount", F.col("amount") + 5)
    for run, day, part in (("run-1", "2024-01-01", rows), ("run-2", "2024-01-02", replay)):
        landing.write_level2(
            relational.with_lineage(part, "shop", day, run), root, source="shop",
            entity="orders", table="orders", mapping_version=version, run_id=run,
            partition={"ingest_date": day},
        )
    every = landing.read_level2(spark, root, "shop", "orders", "orders")
    newest = loads.latest_per_key(every, ["order_id"], ["ingest_date", "_run_id"])
    return newest.select("order_id", "amount", "_run_id")


@suite.query("""
    SELECT o_orderkey AS order_id, o_totalprice AS amount,
           CASE WHEN year(o_orderdate) >= 1998 THEN o_orderpriority END AS priority
    FROM orders
""")
def schema_evolution_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Older rows were written before the priority column existed."""
    rows = table(spark, sf_dir, "orders")
    wide = rows.select(
        F.col("o_orderkey").alias("order_id"), F.col("o_totalprice").alias("amount"),
        F.col("o_orderpriority").alias("priority"), F.year("o_orderdate").alias("y"),
    )
    old = wide.filter("y < 1998").drop("priority")
    return loads.union_evolved([old, wide.filter("y >= 1998")]).drop("y")


@suite.query("""
    SELECT 'crm' AS source_name, c_custkey AS party_id, c_name AS party_name,
           c_mktsegment AS segment, c_nationkey AS nation FROM customer
    UNION ALL
    SELECT 'erp', s_suppkey, s_name, NULL, s_nationkey FROM supplier
""")
def cross_source_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One canonical table, each source its own partition."""
    path = scratch(spark, "party")
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("party_id"), F.col("c_name").alias("party_name"),
        F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation"),
        F.lit("crm").alias("source_name"),
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("party_id"), F.col("s_name").alias("party_name"),
        F.col("s_nationkey").alias("nation"), F.lit("erp").alias("source_name"),
    )
    rows = loads.union_evolved([customers, suppliers])
    loads.load(rows, path, "partition_overwrite", ["source_name"])
    return loads.read_table(spark, path, rows.schema)
