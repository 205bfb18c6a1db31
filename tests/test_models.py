"""SQL models: tokens, order, runs, metrics, column lineage."""

import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from lamina.operators import lineage, metrics
from lamina.operators.contracts import ColumnContract, ContractViolation
from lamina.operators.metrics import Dimension, Metric
from lamina.operators.quality import QualityFailure
from lamina.plans.models import (
    Model,
    Runner,
    SourceRef,
    compile_sql,
    dependency_ids,
    discover,
    in_order,
    token_context,
    with_dependencies,
)
from lamina.suite import modelling


def model(name, sql="SELECT 1 AS a", stage="level3", depends_on=(), **more):
    return Model(stage, "sales", name, sql, name, depends_on=tuple(depends_on), **more)


def test_tokens():
    m = model("m", "{{ environment }} {{run_id}} {{ model.name }} {{window.start_date}} "
              "{{ source.entity_name }} [{{ extra.none }}]",
              sources=(SourceRef("v", "shop", "orders"),))
    context = token_context("dev", "r1", date(2024, 1, 2), extra={"extra": {"none": None}})
    assert compile_sql(m, context) == "dev r1 m 2024-01-02 orders []"
    with pytest.raises(KeyError):
        compile_sql(model("m", "{{ nothing }}"), context)
    with pytest.raises(ValueError):
        compile_sql(model("m", "{{ window }}"), context)


def test_order_and_closure():
    a, b = model("a"), model("b", depends_on=["a"])
    c = model("c", stage="level4", depends_on=["level3.sales.b"])
    d = model("d", stage="level4", depends_on=["c", "level3.sales.a"])
    assert dependency_ids(d) == ["level4.sales.c", "level3.sales.a"]
    assert [m.name for m in in_order([d, c, b, a])] == ["a", "b", "c", "d"]
    assert {m.name for m in with_dependencies([c], [a, b, c, d])} == {"a", "b", "c"}
    with pytest.raises(ValueError, match="unknown"):
        in_order([b])
    with pytest.raises(ValueError, match="depend on each other"):
        in_order([model("x", depends_on=["y"]), model("y", depends_on=["x"])])


def test_model_rules():
    with pytest.raises(ValueError):
        Model("level5", "d", "n", "", "t")
    with pytest.raises(ValueError):
        Model("level3", "d", "n", "", "1t")
    with pytest.raises(ValueError):
        model("m", stage="level4", sources=(SourceRef("v", "s", "e"),))
    with pytest.raises(ValueError):
        model("m", sources=(SourceRef("v", "s", "e"), SourceRef("v", "s", "f")))


def write_model(root, stage, domain, name, manifest, sql):
    folder = root / stage / domain / name
    folder.mkdir(parents=True)
    (folder / "manifest.json").write_text(json.dumps(manifest))
    (folder / "model.sql").write_text(sql)


def test_package_runs_end_to_end(spark, tmp_path):
    package = tmp_path / "package"
    base = {"stage": "level3", "domain": "sales", "name": "base", "load_mode": "append",
            "target": {"table_name": "base", "partition_columns": ["business_date"]},
            "sources": [{"logical_name": "raw", "source_name": "shop", "entity_name": "orders"}]}
    mart = {"stage": "level4", "domain": "sales", "name": "mart", "target": {"table_name": "mart"},
            "depends_on": ["level3.sales.base"], "quality": {"row_count_min": 1}}
    write_model(package, "level3", "sales", "base", base,
                "SELECT * FROM raw WHERE business_date BETWEEN '{{ window.start_date }}' "
                "AND '{{ window.end_date }}'")
    write_model(package, "level4", "sales", "mart", mart,
                "SELECT business_date, sum(amount) AS total FROM base GROUP BY business_date")
    models = discover(str(package))
    assert [m.id for m in models] == ["level3.sales.base", "level4.sales.mart"]
    assert [m.name for m in discover(str(package), stage="level4")] == ["mart"]
    raw = spark.createDataFrame(
        [(i, 7 * i, f"1996-05-{9 + i % 2:02d}") for i in range(1, 8)],
        "order_id long, amount long, business_date string",
    )

    def run(start, end):
        context = token_context("test", "r", start, end)
        runner = Runner(spark, str(tmp_path / "wh"), context, lambda ref: raw)
        return runner, runner.run(models)

    _, first = run(date(1996, 5, 9), date(1996, 5, 9))
    assert [r.load.rows_written for r in first] == [3, 1]
    runner, second = run(date(1996, 5, 10), date(1996, 5, 10))
    assert second[0].load.rows_written == 4
    out = runner.outputs["level4.sales.mart"].collect()
    assert sorted(tuple(r) for r in out) == [("1996-05-09", 7 * (2 + 4 + 6)), ("1996-05-10", 7 * (1 + 3 + 5 + 7))]


def test_manifest_must_match_folder(tmp_path):
    write_model(tmp_path, "level3", "sales", "x",
                {"stage": "level3", "domain": "sales", "name": "y", "target": {"table_name": "y"}}, "")
    with pytest.raises(ValueError, match="manifest says"):
        discover(str(tmp_path))


def runner_for(spark, folder):
    return Runner(spark, folder, token_context("t", "r"), lambda ref: spark.range(3))


def test_failed_expectation_publishes_nothing(spark, folder):
    bad = model("bad", "SELECT 1 AS a UNION ALL SELECT 1", unique_columns=("a",))
    runner = runner_for(spark, folder)
    with pytest.raises(QualityFailure):
        runner.run([model("good"), model("later", depends_on=["bad"]), bad])
    assert [r.model_id for r in runner.runs] == []
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        spark.read.parquet(f"{folder}/level3/bad")


def test_contract_stops_the_run(spark, folder):
    columns = (ColumnContract("a", "string"),)
    with pytest.raises(ContractViolation):
        runner_for(spark, folder).run([model("m", contract="strict", contract_columns=columns)])
    runs = runner_for(spark, folder).run([model("m", contract="warn", contract_columns=columns)])
    assert len(runs[0].contract_warnings) == 1


def test_explain_runs_nothing(spark, folder):
    runner = runner_for(spark, folder)
    plans = runner.explain([model("a"), model("b", "SELECT a + 1 AS b FROM a", depends_on=["a"])])
    assert "Physical Plan" in plans["level3.sales.b"]
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        spark.read.parquet(f"{folder}/level3/a")


def metric(**over):
    spec = dict(domain="sales", name="m", query_ref="level4.sales.mart.amount", aggregation="sum")
    return Metric(**{**spec, **over})


def test_metric_rules():
    for bad in (dict(name="1x"), dict(aggregation="median"), dict(query_ref="a.b.c"),
                dict(dimensions=(Dimension("a"), Dimension("a"))),
                dict(aggregation="cumulative_rolling", dimensions=(Dimension("a"),))):
        with pytest.raises(ValueError):
            metric(**bad)
    assert metric().definition_hash != metric(filters=("amount > 0",)).definition_hash
    metrics.check_declared(metric(), {"level4.sales.mart": ["amount"]})
    with pytest.raises(ValueError):
        metrics.check_declared(metric(), {"level4.sales.mart": ["other"]})


def test_metric_packages(tmp_path):
    folder = tmp_path / "metrics" / "sales" / "m"
    folder.mkdir(parents=True)
    (folder / "manifest.json").write_text(json.dumps({
        "domain": "sales", "name": "m", "query_ref": "level4.sales.mart.amount",
        "aggregation": "sum", "dimensions": [{"name": "d", "is_time_dimension": True}],
        "filters": [{"predicate": "amount > 0"}]}))
    found = metrics.discover(str(tmp_path), "sales.*")
    assert found[0].time_dimension == "d" and found[0].filters == ("amount > 0",)
    assert metrics.discover(str(tmp_path), "crm.*") == []


def test_running_totals(spark):
    df = spark.createDataFrame(
        [("a", "2024-01", 1), ("a", "2024-02", 2), ("a", "2024-04", 4), ("b", "2024-01", 8)],
        "g string, month string, amount int",
    )
    dims = (Dimension("month", True), Dimension("g"))
    running = metric(aggregation="cumulative_rolling", dimensions=dims)
    out = sorted(tuple(r) for r in metrics.compute(df, running).collect())
    assert out == [("a", "2024-01", 1), ("a", "2024-02", 3), ("a", "2024-04", 7), ("b", "2024-01", 8)]
    two = metric(aggregation="cumulative_rolling", dimensions=dims, rolling_periods=2)
    assert [r[2] for r in sorted(metrics.compute(df, two).collect())] == [1, 3, 6, 8]
    fine = df.withColumn("month", F.to_timestamp("month", "yyyy-MM"))
    assert [r[2] for r in sorted(metrics.compute(fine, two).collect())] == [1, 3, 6, 8]
    assert [r[2] for r in sorted(metrics.compute(fine, running).collect())] == [1, 3, 7, 8]


def test_running_totals_over_microseconds(spark):
    times = ["2024-01-01 00:00:00.1", "2024-01-01 00:00:00.2", "2024-01-01 00:00:05",
             "2024-01-01 23:59:59", "2024-01-02 00:00:00", "2024-03-01 12:00:00"]
    df = spark.createDataFrame([(g, t, 1) for g in (None, "a") for t in times],
                               "g string, at string, amount int")
    df = df.withColumn("at", F.col("at").cast("timestamp_ntz"))
    spec = metric(aggregation="cumulative_rolling",
                  dimensions=(Dimension("g"), Dimension("at", True)))
    out = metrics.compute(df, spec).orderBy("g", "at").collect()
    assert [r["m"] for r in out] == [1, 2, 3, 4, 5, 6] * 2


def test_metric_audit_rows_accumulate(spark, folder):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "g string, amount int")
    stats = metrics.audit_stats(df, metric(dimensions=(Dimension("g"),)))
    for run in ("r1", "r2"):
        metrics.write_audit(stats, f"{folder}/audit", "view", run, "2024-01-01T00:00:00Z")
    rows = spark.read.parquet(f"{folder}/audit").collect()
    assert sorted(r["run_id"] for r in rows) == ["r1", "r2"]
    assert {(r["total_sum"], r["non_null_count"]) for r in rows} == {(3.0, 2)}


def test_points_carry_labels(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2)], "g string, amount int")
    row = metrics.points(df, metric(dimensions=(Dimension("g"),))).first()
    assert (row["metric_name"], row["labels"], row["value"]) == ("metric.sales.m", {"g": "a"}, 3.0)
    assert metrics.points(df, metric()).first()["labels"] == {}


@pytest.fixture
def views(spark):
    spark.range(3).select("id", F.col("id").alias("cust"), F.lit(2.0).alias("amount")) \
        .createOrReplaceTempView("l_orders")
    spark.range(3).select(F.col("id").alias("cid"), F.lit("n").alias("name")) \
        .createOrReplaceTempView("l_customers")
    return {"l_orders": "raw.orders", "l_customers": "raw.customers"}


@pytest.mark.parametrize("sql,expected", [
    ("SELECT id, 1 AS one FROM l_orders", {"id": [("raw.orders", "id")], "one": []}),
    ("SELECT concat(id, cust) AS x FROM l_orders", {"x": [("raw.orders", "cust"), ("raw.orders", "id")]}),
    ("SELECT name, sum(amount) AS t FROM l_orders JOIN l_customers ON cust = cid GROUP BY name",
     {"name": [("raw.customers", "name")], "t": [("raw.orders", "amount")]}),
    ("WITH b AS (SELECT id + 1 AS k FROM l_orders), c AS (SELECT k FROM b) SELECT k FROM c",
     {"k": [("raw.orders", "id")]}),
    ("SELECT id AS u FROM l_orders UNION ALL SELECT cid FROM l_customers",
     {"u": [("raw.customers", "cid"), ("raw.orders", "id")]}),
    ("SELECT a.id AS l, b.cust AS r FROM l_orders a JOIN l_orders b ON a.id = b.cust",
     {"l": [("raw.orders", "id")], "r": [("raw.orders", "cust")]}),
    ("SELECT sum(amount) OVER (PARTITION BY cust ORDER BY id) AS w FROM l_orders",
     {"w": [("raw.orders", "amount"), ("raw.orders", "cust"), ("raw.orders", "id")]}),
    ("SELECT s FROM l_orders LATERAL VIEW explode(sequence(0, id)) t AS s",
     {"s": [("raw.orders", "id")]}),
])
def test_column_lineage(spark, views, sql, expected):
    assert lineage.column_lineage(spark.sql(sql), views) == expected


def test_flagship_model_lineage(spark, folder):
    runner = Runner(spark, folder, token_context("t", "r", date(1996, 1, 1), date(1996, 12, 31)),
                    lambda ref: spark.read.parquet("/root/testdata/sf0.001/orders.parquet"))
    runs = runner.run(modelling.SALES_MODELS)
    assert runs[0].lineage["amount"] == [("shop.orders", "o_totalprice")]
    assert runs[2].lineage["total_amount"] == [("canonical_orders", "amount")]
    edges = lineage.column_edges(runner.lineage_events("2024-01-01T00:00:00Z"))
    reached = lineage.column_impact(edges, "shop.orders.o_totalprice", "downstream")
    assert sorted(tuple(r) for r in reached.collect()) == [
        ("base_orders", "amount", 1), ("canonical_orders", "amount", 2),
        ("order_summary", "total_amount", 3),
    ]


def event(spark, source, target, mapping, kind="COMPLETE"):
    return lineage.run_event(spark, kind, "2024-01-01", "r", "j", [source], target,
                             spark.range(1), {c: [(source, o)] for c, o in mapping.items()})


def test_events_edges_and_impact(spark, folder):
    events = event(spark, "a", "b", {"y": "x"})
    for more in (event(spark, "b", "c", {"z": "y"}), event(spark, "c", "a", {"x": "z"}),
                 event(spark, "q", "b", {"y": "w"}, "FAIL")):
        events = events.unionByName(more)
    path = f"{folder}/events"
    events.write.json(path)
    with open(f"{path}/broken.json", "w", encoding="utf-8") as handle:
        handle.write('{"event_type": "COMPLETE", \nnot json\n')
    stored = lineage.read_events(spark, path)
    tables = lineage.table_edges(stored)
    assert sorted(tuple(r) for r in tables.collect()) == [("a", "b"), ("b", "c"), ("c", "a")]
    down = lineage.impact(tables, "a", "downstream", 9)
    assert sorted(tuple(r) for r in down.collect()) == [("b", 1), ("c", 2)]
    assert [tuple(r) for r in lineage.impact(tables, "a", "upstream", 1).collect()] == [("c", 1)]
    columns = lineage.column_impact(lineage.column_edges(stored), "a.x", "downstream", 5)
    assert sorted(tuple(r) for r in columns.collect()) == [("b", "y", 1), ("c", "z", 2)]
    for bad in (dict(direction="sideways"), dict(direction="upstream", depth=0)):
        with pytest.raises(ValueError):
            lineage.impact(tables, "a", **bad)
    with pytest.raises(ValueError):
        lineage.column_impact(tables, "nodot", "upstream")
