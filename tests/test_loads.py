"""Load modes, upserts, late arrivals and replays."""

import os

import pytest
from pyspark.sql import functions as F

from lamina.operators import loads
from lamina.session import scratch


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_full_refresh_and_append_counts(spark, folder):
    path = f"{folder}/t"
    assert loads.load(spark.range(5), path).rows_written == 5
    assert loads.load(spark.range(3), path).rows_written == 3
    assert loads.load(spark.range(10, 12), path, "append").rows_written == 2
    assert rows(spark.read.parquet(path)) == [(0,), (1,), (2,), (10,), (11,)]


def test_partition_overwrite_keeps_siblings(spark, folder):
    path, parts = f"{folder}/t", ["shelf"]
    stock = spark.range(12).selectExpr("id", "concat('s', id % 4) AS shelf")
    loads.load(stock, path, "partition_overwrite", parts)
    recount = spark.createDataFrame([(77, "s2"), (78, "s2")], stock.schema)
    for _ in range(2):
        loads.load(recount, path, "partition_overwrite", parts)
    kept = [tuple(r) for r in stock.collect() if r["shelf"] != "s2"]
    assert rows(loads.read_table(spark, path, stock.schema)) == sorted([*kept, (77, "s2"), (78, "s2")])


def test_a_table_can_be_refreshed_from_itself(spark, folder):
    path = f"{folder}/t"
    loads.load(spark.range(6), path)
    own = spark.read.parquet(path)
    assert loads.load(own.filter("id > 1").unionByName(spark.range(1)), path).rows_written == 5
    assert rows(spark.read.parquet(path)) == [(0,), (2,), (3,), (4,), (5,)]


def test_empty_partition_overwrite_changes_nothing(spark, folder):
    path, parts = f"{folder}/t", ["d"]
    old = spark.createDataFrame([(1, "a")], "id int, d string")
    loads.load(old, path, "partition_overwrite", parts)
    result = loads.load(old.filter("id > 5"), path, "partition_overwrite", parts)
    assert result.rows_written == 0
    assert rows(loads.read_table(spark, path, old.schema)) == [(1, "a")]


def test_refused_output_is_not_published(spark, folder):
    path = f"{folder}/t"
    loads.load(spark.range(2), path)

    def refuse(_):
        raise ValueError("no")

    with pytest.raises(ValueError):
        loads.load(spark.range(9), path, validate=refuse)
    assert spark.read.parquet(path).count() == 2


def test_mode_and_partition_errors(spark, folder):
    with pytest.raises(ValueError):
        loads.load(spark.range(1), folder, "replace")
    with pytest.raises(ValueError):
        loads.load(spark.range(1), folder, "partition_overwrite")
    with pytest.raises(ValueError):
        loads.load(spark.range(1), folder, "append", ["missing"])


def test_default_partitions():
    assert loads.default_partitions("level3", "full_refresh") == []
    assert loads.default_partitions("level3", "append") == ["source_name", "business_date"]
    assert loads.default_partitions("level4", "partition_overwrite") == ["business_date"]
    assert loads.default_partitions("level4", "append", ["x"]) == ["x"]


def test_late_arrivals_land_in_their_day_once(spark, folder):
    path, parts = f"{folder}/t", ["seen_on"]
    # reading r of day d arrives on day d, every fifth one three days later
    readings = spark.range(40).selectExpr(
        "id AS reading", "id % 8 AS seen_on", "id % 8 + CASE WHEN id % 5 = 0 THEN 3 ELSE 0 END AS arrived_on"
    )
    first, late = readings.filter("arrived_on < 6"), readings.filter("arrived_on >= 6")
    loads.load(first.drop("arrived_on"), path, "partition_overwrite", parts)
    for _ in range(2):
        complete = loads.late_partitions(readings, late, "seen_on").drop("arrived_on")
        loads.load(complete, path, "partition_overwrite", parts)
    assert rows(loads.read_table(spark, path, complete.schema)) == rows(readings.drop("arrived_on"))


TARGET = [(1, "a", "x"), (2, "b", "x"), (None, "n", "x")]


@pytest.fixture
def target(spark):
    return spark.createDataFrame(TARGET, "k int, v string, p string")


def test_upsert_updates_and_inserts(spark, target):
    source = spark.createDataFrame([(2, "B", "y"), (3, "C", "y"), (None, "N", "y")], target.schema)
    merged = loads.upsert(target, source, ["k"], ["v"], ["p"])
    assert sorted(merged.collect(), key=str) == sorted(
        spark.createDataFrame(
            [(1, "a", "x"), (2, "B", "x"), (None, "n", "x"), (3, "C", "y"), (None, "N", "y")],
            target.schema,
        ).collect(), key=str,
    )


def test_upsert_branches_and_conditions(spark, target):
    source = spark.createDataFrame([(1, "z", "y"), (2, "", "y"), (3, "C", "y")], target.schema)
    only_insert = loads.upsert(target, source, ["k"], ["v"], ["p"], update=False)
    assert only_insert.filter("k = 1").first()["v"] == "a"
    only_update = loads.upsert(target, source, ["k"], ["v"], ["p"], insert=False)
    assert only_update.count() == 3
    chosen = loads.upsert(target, source, ["k"], ["v"], ["p"],
                          matched_condition="s.v > t.v", not_matched_condition="s.v = 'nothing'")
    assert sorted(r["v"] for r in chosen.collect()) == ["b", "n", "z"]


def test_upsert_rejects_ambiguous_sources(spark, target):
    twice = spark.createDataFrame([(1, "y", "x"), (1, "z", "x")], target.schema)
    with pytest.raises(Exception, match="several source rows"):
        loads.upsert(target, twice, ["k"], ["v"]).collect()
    unmatched = spark.createDataFrame([(8, "y", "x"), (8, "z", "x")], target.schema)
    assert loads.upsert(target, unmatched, ["k"], ["v"], ["p"]).count() == 5
    with pytest.raises(ValueError):
        loads.upsert(target, unmatched, [])
    with pytest.raises(ValueError):
        loads.upsert(target, unmatched, ["k"], update=False, insert=False)


def test_upsert_into_moves_rows_between_partitions(spark, folder):
    path = f"{folder}/t"
    schema = spark.createDataFrame([], "k int, v string, day string").schema
    first = spark.createDataFrame([(1, "a", "d 1"), (2, "b", "d 2"), (3, "c", "d:3")], schema)
    loads.upsert_into(spark, path, schema, first, ["k"], ["day"])
    untouched = {f for d, _, fs in os.walk(path) for f in fs if "d%3A3" in d}
    moved = spark.createDataFrame([(1, "A", "d 2")], schema)
    for _ in range(2):
        loads.upsert_into(spark, path, schema, moved, ["k"], ["day"])
    assert rows(loads.read_table(spark, path, schema)) == [(1, "A", "d 2"), (2, "b", "d 2"), (3, "c", "d:3")]
    assert untouched == {f for d, _, fs in os.walk(path) for f in fs if "d%3A3" in d}


@pytest.mark.parametrize("kind, values", [
    ("boolean", ["true", "false", "true"]),
    ("timestamp_ntz", ["2024-01-01 00:00:00.5", "2024-01-02 00:00:00", "2024-01-03 10:20:30.25"]),
    ("date", ["2024-01-01", "2024-01-02", "2024-01-03"]),
    ("string", ["007", "", "a b/c"]),
    ("int", ["1", "2", None]),
])
def test_vacated_partitions_of_any_type_disappear(spark, folder, kind, values):
    schema = spark.createDataFrame([], f"k int, v string, p {kind}").schema
    cast = F.col("p").cast(kind)
    first = spark.createDataFrame([(i, "a", x) for i, x in enumerate(values)], "k int, v string, p string")
    loads.upsert_into(spark, f"{folder}/t", schema, first.withColumn("p", cast), ["k"], ["p"])
    moved = spark.createDataFrame([(0, "b", values[1]), (2, "c", values[1])], "k int, v string, p string")
    loads.upsert_into(spark, f"{folder}/t", schema, moved.withColumn("p", cast), ["k"], ["p"])
    stored = loads.read_table(spark, f"{folder}/t", schema)
    assert sorted((r["k"], r["v"]) for r in stored.collect()) == [(0, "b"), (1, "a"), (2, "c")]
    assert stored.select("p").distinct().count() == 1


def test_latest_per_key_limits_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, "r1", 5), (1, "r2", 6), (2, "r1", 7)], "k int, run string, v int")
    newest = loads.latest_per_key(df, ["k"], ["run"])
    assert rows(newest) == [(1, "r2", 6), (2, "r1", 7)]
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan


def test_union_evolved(spark):
    old, new = spark.range(1), spark.range(1, 2).withColumn("x", F.lit("y"))
    assert rows(loads.union_evolved([old, new])) == [(0, None), (1, "y")]


def test_scratch_follows_the_session_setting(spark):
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if configured:
        assert scratch(spark, "x").startswith(configured.rstrip("/"))
