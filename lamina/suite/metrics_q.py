"""Semantic metrics, parity and lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.operators import lineage, loads, metrics, parity
from lamina.operators.metrics import Dimension, Metric
from lamina.session import scratch
from lamina.suite import Suite, table

suite = Suite()

MART_SQL = """
    SELECT o_custkey AS customer_id, o_orderstatus AS status, o_orderpriority AS priority,
           {month} AS order_month, CAST(o_orderdate AS DATE) AS order_date, o_totalprice AS amount,
           CAST(round(o_totalprice * 100) AS BIGINT) AS cents
    FROM orders
"""
MART = MART_SQL.format(month="strftime(o_orderdate, '%Y-%m')")
BY_MONTH = (Dimension("priority"), Dimension("order_month", True))


def mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "orders").createOrReplaceTempView("orders")
    return spark.sql(MART_SQL.format(month="date_format(o_orderdate, 'yyyy-MM')"))


def metric(name: str, aggregation: str, column: str = "amount", dims=BY_MONTH, **more) -> Metric:
    return Metric("sales", name, f"level4.sales.orders.{column}", aggregation, dims, **more)


REVENUE = metric("revenue", "sum", filters=("status = 'F'", "amount > 1000"))
SMALLEST = metric("smallest", "min", dims=(Dimension("priority"),))
LARGEST = metric("largest", "max", dims=(Dimension("priority"),))
BUYERS = metric("buyers", "count_distinct", "customer_id")
AVERAGE = metric("average_cents", "average", "cents", dims=(Dimension("order_date", True),))
RUNNING = metric("running", "cumulative_rolling")
QUARTERLY = metric("quarterly", "cumulative_rolling", rolling_periods=3)
NINETY_DAYS = metric("ninety_days", "cumulative_rolling", "cents", (Dimension("status"), Dimension("order_date", True)), rolling_days=90)
TOTAL = metric("grand_total", "sum", dims=())


def rounded(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn(name, F.round(name, 2))


@suite.query(f"""
    SELECT priority, order_month, round(sum(amount), 2) AS revenue FROM ({MART})
    WHERE status = 'F' AND amount > 1000 GROUP BY ALL
""")
def metric_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(metrics.compute(mart(spark, sf_dir), REVENUE), "revenue")


@suite.query(f"SELECT round(sum(amount), 2) AS grand_total FROM ({MART})")
def metric_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(metrics.compute(mart(spark, sf_dir), TOTAL), "grand_total")


@suite.query(f"""
    SELECT priority, min(amount) AS smallest, max(amount) AS largest FROM ({MART}) GROUP BY 1
""")
def metric_min_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mart(spark, sf_dir)
    return metrics.compute(rows, SMALLEST).join(metrics.compute(rows, LARGEST), "priority")


@suite.query(f"""
    SELECT priority, order_month, count(DISTINCT customer_id) AS buyers FROM ({MART}) GROUP BY ALL
""")
def metric_count_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.compute(mart(spark, sf_dir), BUYERS)


@suite.query(f"""
    SELECT order_date, avg(cents) AS average_cents FROM ({MART}) GROUP BY 1
""")
def metric_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.compute(mart(spark, sf_dir), AVERAGE)


@suite.query(f"""
    SELECT priority, order_month, round(sum(sum(amount)) OVER (
        PARTITION BY priority ORDER BY order_month ROWS UNBOUNDED PRECEDING), 2) AS running
    FROM ({MART}) GROUP BY priority, order_month
""")
def metric_cumulative(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(metrics.compute(mart(spark, sf_dir), RUNNING), "running")


@suite.query("""
    SELECT event_type, ts, round(sum(sum(value)) OVER (
        PARTITION BY event_type ORDER BY ts ROWS UNBOUNDED PRECEDING), 2) AS running_value
    FROM events GROUP BY event_type, ts
""")
def metric_cumulative_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running total over a fine-grained time dimension, taken per day and within the day."""
    spec = Metric(
        "app", "running_value", "level4.app.events.value", "cumulative_rolling",
        (Dimension("event_type"), Dimension("ts", True)),
    )
    return rounded(metrics.compute(table(spark, sf_dir, "events"), spec), "running_value")


@suite.query(f"""
    SELECT priority, order_month, round(sum(sum(amount)) OVER (
        PARTITION BY priority ORDER BY order_month ROWS 2 PRECEDING), 2) AS quarterly
    FROM ({MART}) GROUP BY priority, order_month
""")
def metric_rolling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(metrics.compute(mart(spark, sf_dir), QUARTERLY), "quarterly")


@suite.query(f"""
    SELECT status, order_date, CAST(sum(sum(cents)) OVER (PARTITION BY status ORDER BY order_date
        RANGE BETWEEN INTERVAL 89 DAY PRECEDING AND CURRENT ROW) AS BIGINT) AS ninety_days
    FROM ({MART}) GROUP BY status, order_date
""")
def metric_rolling_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of 90 days of calendar time; days without orders count as time."""
    return metrics.compute(mart(spark, sf_dir), NINETY_DAYS)


@suite.query(f"""
    SELECT 'metric.sales.buyers' AS metric_name, 'gauge' AS metric_type, priority, order_month,
           CAST(count(DISTINCT customer_id) AS DOUBLE) AS value
    FROM ({MART}) GROUP BY priority, order_month
""")
def metric_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = metrics.points(mart(spark, sf_dir), BUYERS)
    label = F.col("labels")
    return found.select(
        "metric_name", "metric_type", label["priority"].alias("priority"),
        label["order_month"].alias("order_month"), "value",
    )


@suite.query(f"""
    SELECT 'sales.buyers' AS metric_id, CAST(sum(n) AS DOUBLE) AS total_sum,
           count(n) AS non_null_count, CAST(min(n) AS DOUBLE) AS min_value,
           CAST(max(n) AS DOUBLE) AS max_value
    FROM (SELECT count(DISTINCT customer_id) AS n FROM ({MART}) GROUP BY priority, order_month)
""")
def metric_audit_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.audit_stats(mart(spark, sf_dir), BUYERS).drop("definition_hash")


@suite.query(f"""
    SELECT 'table' AS served_by, count(*) AS rows_served FROM (
        SELECT DISTINCT priority, order_month FROM ({MART}))
    UNION ALL SELECT 'differences', 0
""")
def metric_modes_agree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored metric and the view must hold the same rows."""
    rows, folder = mart(spark, sf_dir), scratch(spark, "metrics")
    stored = metrics.materialize(rows, BUYERS, folder)
    view = spark.table(metrics.create_view(rows, BUYERS))
    kept = loads.read_table(spark, stored.path, view.schema)
    apart = metrics.differences(kept, view)
    served = kept.agg(F.count(F.lit(1)).alias("rows_served"))
    return served.select(F.lit("table").alias("served_by"), "rows_served").unionByName(
        apart.agg(F.count(F.lit(1)).alias("rows_served")).select(
            F.lit("differences").alias("served_by"), "rows_served"
        )
    )


def two_versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders, and orders with late 'P' rows repriced and one status missing."""
    old = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    repriced = F.when(
        (F.col("o_orderstatus") == "P") & (F.col("o_totalprice") > 300000),
        F.col("o_totalprice") + 1,
    ).otherwise(F.col("o_totalprice"))
    new = old.withColumn("o_totalprice", repriced).filter(
        "NOT (o_orderstatus = 'F' AND o_totalprice < 5000)"
    )
    return old, new


@suite.query("""
    SELECT 'customer' AS model_id, count(*) AS left_rows, count(*) AS right_rows,
           'match' AS status FROM customer
    UNION ALL
    SELECT 'orders', count(*), count(*) FILTER (NOT (o_orderstatus = 'F' AND o_totalprice < 5000)),
           'mismatch' FROM orders
    UNION ALL SELECT 'part', count(*), NULL, 'missing_right' FROM part
    UNION ALL SELECT 'supplier', NULL, count(*), 'missing_left' FROM supplier
""")
def table_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = two_versions(spark, sf_dir)
    customer = table(spark, sf_dir, "customer")
    shuffled = customer.select(*reversed(customer.columns)).repartition("c_mktsegment")
    left = {"customer": customer, "orders": old, "part": table(spark, sf_dir, "part")}
    right = {"customer": shuffled, "orders": new, "supplier": table(spark, sf_dir, "supplier")}
    return parity.compare_reports(parity.parity_report(left), parity.parity_report(right))


OLD = "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders"
NEW = """SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'P' AND o_totalprice > 300000
    THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice FROM orders
    WHERE NOT (o_orderstatus = 'F' AND o_totalprice < 5000)"""


@suite.query(f"""
    SELECT *, 'left' AS side FROM ({OLD} EXCEPT ALL {NEW})
    UNION ALL SELECT *, 'right' AS side FROM ({NEW} EXCEPT ALL {OLD})
""")
def row_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parity.row_differences(*two_versions(spark, sf_dir))


# Lineage: one completed run per row of the key graph region - nation - customer - order -
# line - report by return flag. Node names carry the key.
EDGES = """
    SELECT 'region:' || n_regionkey AS source, 'nation:' || n_nationkey AS target,
           'n_regionkey' AS via FROM nation
    UNION ALL SELECT 'nation:' || c_nationkey, 'customer:' || c_custkey, 'c_nationkey' FROM customer
    UNION ALL SELECT 'customer:' || o_custkey, 'order:' || o_orderkey, 'o_custkey' FROM orders
    UNION ALL SELECT 'order:' || l_orderkey, 'line:' || l_orderkey || '-' || l_linenumber,
                     'l_orderkey' FROM lineitem
    UNION ALL SELECT 'line:' || l_orderkey || '-' || l_linenumber, 'report:' || l_returnflag,
                     'l_linenumber' FROM lineitem
"""


def lineage_events(spark: SparkSession, sf_dir: str, columns: bool = False) -> DataFrame:
    """The events as JSON lines, written and read back; with column facets if asked for."""
    for t in ("nation", "customer", "orders", "lineitem"):
        table(spark, sf_dir, t).createOrReplaceTempView(t)
    edges = spark.sql(EDGES)
    namespace = F.lit("lamina").alias("namespace")
    column = F.struct(namespace, F.col("source").alias("name"), F.lit("id").alias("field"))
    facets = F.struct(
        F.struct(
            F.create_map(F.col("via"), F.struct(F.array(column).alias("inputFields"))).alias(
                "fields"
            )
        ).alias("columnLineage")
    ).alias("facets")
    events = edges.select(
        F.lit("COMPLETE").alias("event_type"),
        F.lit("2024-01-01T00:00:00Z").alias("event_time"),
        F.md5(F.concat("source", "target")).alias("run_id"),
        F.col("via").alias("job_name"),
        F.array(F.struct(namespace, F.col("source").alias("name"))).alias("inputs"),
        F.array(F.struct(namespace, F.col("target").alias("name"), *([facets] if columns else [])))
        .alias("outputs"),
    )
    path = scratch(spark, "lineage")
    kinds = F.when(
        F.col("job_name") == "c_nationkey", F.array(F.lit("START"), F.lit("COMPLETE"))
    ).otherwise(F.array(F.lit("COMPLETE")))
    lineage.write_events(events.withColumn("event_type", F.explode(kinds)), path)
    return lineage.read_events(spark, path)


@suite.query(f"SELECT DISTINCT source, target FROM ({EDGES})")
def lineage_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineage.table_edges(lineage_events(spark, sf_dir))


@suite.query(f"""
    SELECT DISTINCT source, 'id' AS source_column, target, via AS target_column FROM ({EDGES})
""")
def lineage_column_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineage.column_edges(lineage_events(spark, sf_dir, columns=True))


def walk_sql(start: str, here: str, there: str, depth: int) -> str:
    return f"""
        WITH RECURSIVE edges AS ({EDGES}), walk(node, depth) AS (
            SELECT '{start}', 0
            UNION
            SELECT e.{there}, w.depth + 1 FROM walk w JOIN edges e ON e.{here} = w.node
            WHERE w.depth < {depth})
        SELECT node, CAST(min(depth) AS INTEGER) AS depth FROM walk WHERE depth > 0 GROUP BY node
    """


@suite.query(walk_sql("region:1", "source", "target", 5))
def impact_downstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = lineage.table_edges(lineage_events(spark, sf_dir))
    return lineage.impact(edges, "region:1", "downstream", 5)


@suite.query(walk_sql("report:A", "target", "source", 4))
def impact_upstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = lineage.table_edges(lineage_events(spark, sf_dir))
    return lineage.impact(edges, "report:A", "upstream", 4)


@suite.query(f"""
    WITH RECURSIVE edges AS ({EDGES}), walk(start, node, depth) AS (
        SELECT start, start, 0 FROM (
            SELECT 'region:' || r_regionkey AS start FROM region
            UNION ALL SELECT 'customer:' || c_custkey FROM customer WHERE c_custkey % 10 = 3)
        UNION
        SELECT w.start, e.target, w.depth + 1 FROM walk w JOIN edges e ON e.source = w.node WHERE w.depth < 3)
    SELECT start, node, CAST(min(depth) AS INTEGER) AS depth FROM walk WHERE depth > 0 GROUP BY start, node
""")
def impact_many_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All that lies up to three steps below each region and each tenth customer, in one run."""
    edges = lineage.table_edges(lineage_events(spark, sf_dir))
    regions = table(spark, sf_dir, "region").select(F.concat(F.lit("region:"), "r_regionkey").alias("start"))
    some = table(spark, sf_dir, "customer").where("c_custkey % 10 = 3")
    starts = regions.unionByName(some.select(F.concat(F.lit("customer:"), "c_custkey").alias("start")))
    return lineage.impact_of_many(edges, starts, "downstream", 3)
