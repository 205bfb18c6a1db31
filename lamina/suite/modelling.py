"""SQL models, joins, aggregates and windows."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.functions.hashing import artifact_id, row_md5
from lamina.plans.models import Model, Runner, SourceRef, token_context
from lamina.session import scratch
from lamina.suite import Suite, table

suite = Suite()

BASE_ORDERS = Model(
    "level3", "sales", "base_orders",
    """
    SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderpriority AS priority,
           o_totalprice AS amount, CAST(o_orderdate AS DATE) AS order_date,
           CAST(NULL AS STRING) AS note, '{{ source.source_name }}' AS source_name
    FROM raw_orders
    WHERE CAST(o_orderdate AS DATE)
          BETWEEN DATE '{{ window.start_date }}' AND DATE '{{ window.end_date }}'
    """,
    "base_orders",
    sources=(SourceRef("raw_orders", "shop", "orders"),),
)
CANONICAL_ORDERS = Model(
    "level3", "sales", "canonical_orders",
    """
    WITH base AS (SELECT * FROM base_orders)
    SELECT order_id, customer_id, priority, amount, order_date, source_name,
           date_format(order_date, 'yyyy-MM') AS business_month
    FROM base
    """,
    "canonical_orders",
    load_mode="partition_overwrite",
    partition_columns=("source_name", "business_month"),
    depends_on=("base_orders",),
    row_count_min=1,
    unique_columns=("order_id",),
    not_null_columns=("order_id", "order_date"),
)
ORDER_SUMMARY = Model(
    "level4", "sales", "order_summary",
    """
    SELECT order_date, round(sum(amount), 2) AS total_amount
    FROM canonical_orders GROUP BY order_date
    """,
    "order_summary",
    depends_on=("level3.sales.canonical_orders",),
    row_count_min=1,
)
SALES_MODELS = (ORDER_SUMMARY, CANONICAL_ORDERS, BASE_ORDERS)


def run_sales(spark: SparkSession, sf_dir: str, start: date, end: date) -> Runner:
    runner = Runner(
        spark,
        scratch(spark, "warehouse"),
        token_context("test", "run-1", start, end),
        lambda ref: table(spark, sf_dir, ref.entity_name),
    )
    runner.run(SALES_MODELS)
    return runner


@suite.query("""
    SELECT CAST(o_orderdate AS DATE) AS order_date, round(sum(o_totalprice), 2) AS total_amount
    FROM orders
    WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'
    GROUP BY 1
""")
def daily_order_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    runner = run_sales(spark, sf_dir, date(1996, 1, 1), date(2000, 12, 31))
    return runner.outputs["level4.sales.order_summary"]


@suite.query("""
    SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderpriority AS priority,
           o_totalprice AS amount, CAST(o_orderdate AS DATE) AS order_date,
           'shop' AS source_name, strftime(o_orderdate, '%Y-%m') AS business_month
    FROM orders
""")
def canonical_orders_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    runner = run_sales(spark, sf_dir, date(1990, 1, 1), date(2010, 12, 31))
    return runner.outputs["level3.sales.canonical_orders"]


def sql_query(name: str, tables: str, spark_sql: str, oracle: str | None = None) -> None:
    """Register a query whose body is Spark SQL over named tables, as a model body is."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        for t in tables.split():
            table(spark, sf_dir, t).createOrReplaceTempView(t)
        return spark.sql(spark_sql)

    suite.query(oracle or spark_sql, name)(run)


sql_query("priority_sales", "orders", """
    SELECT o_orderpriority, o_orderstatus, count(*) AS orders,
           round(sum(o_totalprice), 2) AS total
    FROM orders GROUP BY o_orderpriority, o_orderstatus ORDER BY total DESC
""")
sql_query("top_customers", "orders customer", """
    SELECT c.c_name, c.c_mktsegment, o.orders, o.total
    FROM (SELECT o_custkey, count(*) AS orders, round(sum(o_totalprice), 2) AS total
          FROM orders GROUP BY o_custkey) o
    JOIN customer c ON c.c_custkey = o.o_custkey
    ORDER BY o.total DESC, c.c_name
""")
sql_query("layer_counts", "region nation customer supplier part orders lineitem", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}"
    for t in "region nation customer supplier part orders lineitem".split()
))
# shipments: one per order, its carrier is the supplier of the first line
SHIPMENTS = """
    SELECT l_orderkey AS order_id, min(l_shipdate) AS ship_date,
           {first_carrier} AS carrier_id
    FROM lineitem GROUP BY l_orderkey
"""
SPARK_SHIPMENTS = SHIPMENTS.format(
    first_carrier="min_by(l_suppkey, struct(l_shipdate, l_linenumber, l_suppkey))"
)
DUCK_SHIPMENTS = SHIPMENTS.format(
    first_carrier="arg_min(l_suppkey, (l_shipdate, l_linenumber, l_suppkey))"
)
LEFT_SHIP = """
    WITH shipments AS ({shipments})
    SELECT o.o_orderkey, s.carrier_id,
           CAST({days} AS INT) AS days_to_ship
    FROM orders o LEFT JOIN shipments s ON s.order_id = o.o_orderkey
"""
sql_query(
    "orders_left_join_ship", "orders lineitem",
    LEFT_SHIP.format(shipments=SPARK_SHIPMENTS, days="datediff(s.ship_date, o.o_orderdate)"),
    LEFT_SHIP.format(
        shipments=DUCK_SHIPMENTS, days="date_diff('day', o.o_orderdate, s.ship_date)"
    ),
)
CARRIERS = """
    WITH shipments AS ({shipments}), carriers AS (
        SELECT s.carrier_id, count(*) AS shipments,
               sum({days}) / CAST(count({days}) AS DOUBLE) AS avg_days,
               min({year}) AS first_year
        FROM shipments s JOIN orders o ON o.o_orderkey = s.order_id
        GROUP BY s.carrier_id)
    SELECT sup.s_name AS carrier, c.shipments, c.avg_days, c.first_year
    FROM carriers c LEFT JOIN supplier sup ON sup.s_suppkey = c.carrier_id
"""
sql_query(
    "carrier_performance", "orders lineitem supplier",
    CARRIERS.format(shipments=SPARK_SHIPMENTS, days="datediff(s.ship_date, o.o_orderdate)",
                    year="CAST(date_part('year', s.ship_date) AS BIGINT)"),
    CARRIERS.format(shipments=DUCK_SHIPMENTS,
                    days="date_diff('day', o.o_orderdate, s.ship_date)",
                    year="date_part('year', s.ship_date)"),
)
sql_query("join_semi", "orders customer", """
    SELECT c_custkey, c_name FROM customer
    WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)
""")
sql_query("join_anti", "orders lineitem", """
    SELECT o_orderkey, o_orderstatus FROM orders
    WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)
""")
sql_query("join_full", "customer supplier", """
    SELECT coalesce(c.nation, s.nation) AS nation, c.customers, s.suppliers
    FROM (SELECT c_nationkey AS nation, count(*) AS customers FROM customer
          WHERE c_acctbal > 0 GROUP BY c_nationkey) c
    FULL OUTER JOIN (SELECT s_nationkey AS nation, count(*) AS suppliers FROM supplier
          WHERE s_acctbal > 5000 GROUP BY s_nationkey) s ON c.nation = s.nation
""")
sql_query("join_right", "customer orders", """
    SELECT c.c_custkey, c.c_name, o.orders
    FROM (SELECT o_custkey, count(*) AS orders FROM orders
          WHERE o_orderstatus = 'F' GROUP BY o_custkey) o
    RIGHT JOIN customer c ON c.c_custkey = o.o_custkey
""")
sql_query("join_range", "customer supplier", """
    SELECT c.c_custkey, c.c_acctbal, s.low, s.high
    FROM customer c
    JOIN (SELECT s_nationkey, min(s_acctbal) AS low, max(s_acctbal) AS high
          FROM supplier GROUP BY s_nationkey) s
      ON c.c_nationkey = s.s_nationkey AND c.c_acctbal BETWEEN s.low AND s.high
""")
sql_query("rollup_cube", "lineitem", """
    SELECT l_returnflag, l_linestatus, count(*) AS n,
           round(sum(l_extendedprice), 2) AS total
    FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)
""")
sql_query("grouping_rollup", "orders", """
    SELECT o_orderpriority, o_orderstatus, round(sum(o_totalprice), 2) AS total
    FROM orders GROUP BY ROLLUP (o_orderpriority, o_orderstatus)
""")
sql_query("rank_topk", "orders", """
    SELECT * FROM (
        SELECT o_orderpriority, o_orderkey, o_totalprice,
               CAST(row_number() OVER (PARTITION BY o_orderpriority
                    ORDER BY o_totalprice DESC, o_orderkey) AS BIGINT) AS position
        FROM orders) ranked
    WHERE position <= 10
""")
LAG_LEAD = """
    WITH monthly AS (
        SELECT o_orderpriority, {month} AS month, count(*) AS orders
        FROM orders GROUP BY 1, 2)
    SELECT o_orderpriority, month, orders,
           lag(orders) OVER (PARTITION BY o_orderpriority ORDER BY month) AS prev,
           lead(orders) OVER (PARTITION BY o_orderpriority ORDER BY month) AS next
    FROM monthly
"""
sql_query(
    "lag_lead", "orders",
    LAG_LEAD.format(month="date_format(o_orderdate, 'yyyy-MM')"),
    LAG_LEAD.format(month="strftime(o_orderdate, '%Y-%m')"),
)
sql_query("set_ops", "customer orders", """
    SELECT 'ordered' AS label, c_custkey FROM (
        SELECT c_custkey FROM customer INTERSECT SELECT o_custkey FROM orders) a
    UNION ALL
    SELECT 'idle' AS label, c_custkey FROM (
        SELECT c_custkey FROM customer EXCEPT
        SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01') b
    UNION
    SELECT 'big' AS label, o_custkey FROM orders WHERE o_totalprice > 450000
""")
sql_query(
    "pivot_status", "orders",
    """
    SELECT o_orderpriority, F AS filled, O AS open, P AS pending
    FROM (SELECT o_orderpriority, o_orderstatus FROM orders)
    PIVOT (count(*) FOR o_orderstatus IN ('F' AS F, 'O' AS O, 'P' AS P))
    """,
    """
    SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS filled,
           count(*) FILTER (o_orderstatus = 'O') AS open,
           count(*) FILTER (o_orderstatus = 'P') AS pending
    FROM orders GROUP BY 1
    """,
)
sql_query("distinct_pairs", "lineitem", """
    SELECT DISTINCT l_returnflag, l_linestatus, l_suppkey FROM lineitem
""")


@suite.query("""
    SELECT o_orderpriority, min(o_totalprice) AS low, max(o_totalprice) AS high
    FROM orders GROUP BY 1
""")
def quantile_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Approximate quantiles at 0 and 1 are exact, so they can be compared."""
    return table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(
        F.percentile_approx("o_totalprice", 0.0).alias("low"),
        F.percentile_approx("o_totalprice", 1.0).alias("high"),
    )


sql_query(
    "array_functions", "documents",
    """
    SELECT doc_id, size(filter(split(text, ' '), w -> length(w) > 5)) AS long_words,
           aggregate(transform(split(text, ' '), w -> CAST(length(w) AS BIGINT)), 0L,
                     (a, n) -> a + n) AS letters,
           array_max(transform(split(text, '\n'), l -> length(l))) AS longest_line
    FROM documents
    """,
    """
    SELECT doc_id, CAST(len(list_filter(string_split(text, ' '), lambda w: length(w) > 5)) AS INTEGER)
               AS long_words,
           CAST(list_sum(list_transform(string_split(text, ' '), lambda w: length(w))) AS BIGINT)
               AS letters,
           CAST(list_max(list_transform(string_split(text, chr(10)), lambda l: length(l))) AS INTEGER)
               AS longest_line
    FROM documents
    """,
)
sql_query(
    "json_functions", "events",
    """
    SELECT event_id, variant_get(parse_json(props), '$.k', 'bigint') AS k,
           get_json_object(props, '$.missing') AS missing,
           to_json(named_struct('id', event_id, 'type', event_type)) AS body
    FROM events
    """,
    """
    SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
           json_extract_string(props, '$.missing') AS missing,
           CAST(to_json({'id': event_id, 'type': event_type}) AS VARCHAR) AS body
    FROM events
    """,
)
sql_query(
    "formatted_report", "orders",
    """
    SELECT date_format(o_orderdate, 'yyyy') AS year, format_number(sum(o_totalprice), 2) AS total,
           datediff(max(o_orderdate), min(o_orderdate)) AS days,
           CAST(date_part('doy', max(o_orderdate)) AS BIGINT) AS last_day
    FROM orders GROUP BY 1
    """,
    """
    SELECT strftime(o_orderdate, '%Y') AS year, format('{:,.2f}', sum(o_totalprice)) AS total,
           CAST(date_diff('day', min(o_orderdate), max(o_orderdate)) AS INTEGER) AS days,
           date_part('doy', max(o_orderdate)) AS last_day
    FROM orders GROUP BY 1
    """,
)


@suite.query("""
    SELECT o_orderkey, md5(CAST(to_json({'o_orderkey': o_orderkey,
               'o_orderpriority': o_orderpriority, 'o_orderstatus': o_orderstatus}) AS VARCHAR))
               AS row_digest,
           substr(sha256('run-1:' || o_orderpriority), 1, 24) AS artifact
    FROM orders
""")
def row_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["o_orderkey", "o_orderstatus", "o_orderpriority"]
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", row_md5(columns).alias("row_digest"),
        artifact_id(F.lit("run-1"), F.col("o_orderpriority")).alias("artifact"),
    )
