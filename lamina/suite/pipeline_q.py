"""The whole way: land, normalize, model, publish."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.operators import export, relational
from lamina.operators.export import Publish
from lamina.operators.normalize import normalize
from lamina.plans.models import Model, Runner, SourceRef, token_context
from lamina.session import scratch
from lamina.sources import files, landing
from lamina.suite import Suite, table

suite = Suite()

ORDERS = Model(
    "level3", "sales", "canonical_orders",
    """
    SELECT order_id, customer__id AS customer_id, customer__name AS customer_name,
           CAST(amount AS DECIMAL(12,2)) AS order_total, CAST(order_date AS DATE) AS order_date,
           source_name, ingest_date, substr(order_date, 1, 7) AS business_month
    FROM raw_orders
    WHERE order_date BETWEEN '{{ window.start_date }}' AND '{{ window.end_date }}'
    """,
    "canonical_orders",
    load_mode="partition_overwrite",
    partition_columns=("source_name", "business_month"),
    sources=(SourceRef("raw_orders", "shop", "orders", "orders"),),
    unique_columns=("order_id",),
)
SHIPMENTS = Model(
    "level3", "inventory", "canonical_shipments",
    """
    SELECT o.order_id, min(CAST(d.value AS DATE)) AS ship_date, o.source_name
    FROM raw_ship_dates d JOIN raw_orders o ON d._parent_row_id = o._row_id
    GROUP BY o.order_id, o.source_name
    """,
    "canonical_shipments",
    sources=(
        SourceRef("raw_ship_dates", "shop", "orders", "orders__ship_dates"),
        SourceRef("raw_orders", "shop", "orders", "orders"),
    ),
)
FULFILMENT = Model(
    "level4", "sales", "fulfilment",
    """
    SELECT o.order_date, count(*) AS orders, CAST(sum(o.order_total) AS DECIMAL(18,2)) AS revenue,
           max(datediff(s.ship_date, o.order_date)) AS slowest_days
    FROM canonical_orders o LEFT JOIN canonical_shipments s ON s.order_id = o.order_id
    GROUP BY o.order_date
    """,
    "fulfilment",
    depends_on=("level3.sales.canonical_orders", "level3.inventory.canonical_shipments"),
    row_count_min=1,
)


def order_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as nested documents: the customer as a struct, three planned ship dates as a list."""
    orders, customers = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    day = F.to_date("o_orderdate")
    offset = F.length("o_orderpriority")
    planned = F.array(*[
        F.date_add(day, (offset + n).cast("int")).cast("string") for n in (3, 1, 2)
    ])
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("order_id"), day.cast("string").alias("order_date"),
        F.col("o_totalprice").alias("amount"),
        F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")).alias("customer"),
        planned.alias("ship_dates"),
    )


@suite.query("""
    SELECT strftime(o_orderdate, '%Y-%m-%d') AS order_date, CAST(count(*) AS VARCHAR) AS orders,
           CAST(CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DECIMAL(18,2)) AS VARCHAR) AS revenue,
           CAST(max(length(o_orderpriority) + 1) AS VARCHAR) AS slowest_days
    FROM orders JOIN customer ON o_custkey = c_custkey
    WHERE o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '2000-12-31'
    GROUP BY 1
""")
def pipeline_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines landed, flattened to level 2, modelled to levels 3 and 4, delivered as CSV."""
    root = scratch(spark, "pipeline")
    docs = order_documents(spark, sf_dir)
    landing.land(docs, f"{root}/level1/orders", "jsonl")
    raw = files.scan_json_lines(spark, f"{root}/level1/orders", docs.schema)
    normalize(
        raw, root, source="shop", entity="orders", run_id="run-1", ingest_date="2024-01-02",
        row_id=relational.document_key(F.col("order_id")), partition={"ingest_date": "2024-01-02"},
    )
    runner = Runner(
        spark, f"{root}/warehouse",
        token_context("test", "run-2", date(1996, 1, 1), date(2000, 12, 31)),
        lambda ref: landing.read_level2(
            spark, root, ref.source_name, ref.entity_name, ref.table_name
        ),
    )
    runner.run([FULFILMENT, SHIPMENTS, ORDERS])
    spec = Publish("sales", "fulfilment", "csv", replacement="overwrite_in_place")
    export.publish(runner.outputs[FULFILMENT.id], spec, root, "run-3", "1996_to_2000")
    return spark.read.csv(export.plan_paths(spec, root, "run-3")["stable"], header=True)
