"""Sketches, exact quantiles, interval joins and calendar totals against plain computations."""

import math
import os
import random
from collections import Counter, defaultdict
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lamina.operators import intervals, loads, maintenance, metrics, sketches
from lamina.operators.metrics import Dimension, Metric


@pytest.fixture(autouse=True)
def shared(spark, folder):
    spark.sparkContext.setCheckpointDir(f"{folder}/shared")


def files_of(path):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(path) for f in fs}


def test_sketches_of_days_merge_within_their_error(spark, folder):
    spec = sketches.SketchSpec({"users": "u"}, {"v": "v"}, entries_log2=10, k=200)
    rows = spark.range(60_000).select(
        F.date_add(F.lit(date(2024, 1, 1)), (F.col("id") % 6).cast("int")).alias("day"),
        F.when(F.col("id") % 3 > 0, "a").otherwise("b").alias("kind"),
        (F.col("id") * 7919 % 20_000).alias("u"),
        F.when(F.col("id") % 10 > 0, (F.col("id") * 104729 % 60_000).cast("double")).alias("v"),
    ).cache()
    first = rows.where("day < '2024-01-04'")
    sketches.store_partitions(first, f"{folder}/s", spec, ["kind"], ["day"])
    before = files_of(f"{folder}/s")
    for again in range(2):  # a day that is written again replaces itself
        sketches.store_partitions(rows.where("day >= '2024-01-04'"), f"{folder}/s", spec, ["kind"], ["day"])
    kept = {f: t for f, t in files_of(f"{folder}/s").items() if "day=" in f}
    assert {f: t for f, t in before.items() if "day=" in f}.items() <= kept.items()
    found = sketches.estimates(spark.read.parquet(f"{folder}/s"), spec, ["kind"], [0.1, 0.5, 0.99]).collect()
    for r in found:
        own = rows.where(F.col("kind") == r.kind)
        exact = own.agg(F.count("*"), F.count_distinct("u")).first()
        assert r["rows"] == exact[0] and abs(r.users / exact[1] - 1) <= 1.5 * spec.distinct_error
        values = sorted(x.v for x in own.where("v is not null").collect())
        for p, value in zip((0.1, 0.5, 0.99), r.v):
            rank = sum(x <= value for x in values) / len(values)
            assert abs(rank - p) <= 1.5 * spec.rank_error
    rows.unpersist()


def test_sketch_metric_and_common_values(spark, folder):
    spec = Metric("app", "users", "level4.app.events.u", "count_distinct", (Dimension("kind"),), ("ok",))
    data = [("d1", "a", 1, True), ("d1", "a", 2, True), ("d1", "a", 3, False), ("d1", None, None, True),
            ("d2", "a", 2, True), ("d2", "b", 9, True)]
    df = spark.createDataFrame(data, "day string, kind string, u int, ok boolean")
    for day in ("d1", "d2"):
        sketches.store_metric(df.where(F.col("day") == day), spec, f"{folder}/m", ["day"])
    found = sketches.read_metric(spark, spec, f"{folder}/m")
    assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, metrics.compute(df, spec).collect()), key=str)
    stored = spark.read.parquet(f"{folder}/m")
    sides = [stored.where(F.col("day") == d) for d in ("d1", "d2")]
    assert list(map(tuple, sketches.common(*sides, sketches.metric_spec(spec), ["kind"]).collect())) == [("a", 1)]
    with pytest.raises(ValueError, match="distinct counts"):
        sketches.metric_spec(Metric("app", "n", "level4.app.events.u", "sum"))
    with pytest.raises(ValueError, match="repeat"):
        sketches.SketchSpec({"a": "u"}, {"a": "v"})


def test_exact_quantiles(spark):
    r = random.Random(5)
    data = [(g, r.choice([None, 1.0, r.random(), r.randint(0, 9) / 2])) for g in ("x", "y", None) for _ in range(r.randint(1, 90))]
    data += [("hot", 7.0)] * 500 + [("one", 3.0), ("none", None)]
    df = spark.createDataFrame(data, "g string, v double")
    wanted = {"least": 0.0, "low": 0.25, "mid": 0.5, "most": 1.0}
    groups = defaultdict(list)
    for g, v in data:
        if v is not None:
            groups[g].append(v)
    want = {g: tuple(sorted(vs)[max(math.ceil(p * len(vs)), 1) - 1] for p in wanted.values()) for g, vs in groups.items()}
    found = sketches.exact_quantiles(df, ["g"], "v", wanted).collect()
    assert {x["g"]: tuple(x[n] for n in wanted) for x in found} == want
    assert sketches.exact_quantiles(df, [], "v", {"m": 1.0}).first().m == 7.0
    with pytest.raises(ValueError, match="between"):
        sketches.exact_quantiles(df, ["g"], "v", {"x": 2})


def overlaps(a, b, closed):
    if None in (*a, *b) or not (a[0] <= a[1] and b[0] <= b[1] if closed else a[0] < a[1] and b[0] < b[1]):
        return False
    return a[0] <= b[1] and b[0] <= a[1] if closed else a[0] < b[1] and b[0] < a[1]


@pytest.mark.parametrize("closed", [True, False])
@pytest.mark.parametrize("crowded", [4, 20_000])
def test_overlaps_are_those_of_all_pairs(spark, closed, crowded):
    r = random.Random(7)

    def some(n, scale):
        rows = []
        for i in range(n):
            start = r.choice([r.randint(-50, 1_000), 500, r.uniform(0, 1_000)])
            length = r.choice([0, 1, r.randint(0, 8), r.uniform(0, scale), -3])
            rows.append((i, r.choice("ab") if r.random() < 0.9 else None, float(start), float(start + length)))
        return rows + [(n, "a", -1e6, 1e6), (n + 1, "b", 500.0, 500.0), (n + 2, "a", None, 3.0), (n + 3, "a", 500.0, 501.0)]

    left, right = some(150, 40), some(120, 300)
    a = spark.createDataFrame(left, "i int, k string, s double, e double")
    b = spark.createDataFrame(right, "j int, k string, t double, f double")
    found = intervals.overlap_join(a, b, ("s", "e"), ("t", "f"), ["k"], closed, crowded)
    assert found.columns == ["i", "k", "s", "e", "j", "t", "f"]
    want = Counter((x[0], y[0]) for x in left for y in right if x[1] and x[1] == y[1] and overlaps(x[2:], y[2:], closed))
    assert Counter((x.i, x.j) for x in found.collect()) == want
    assert "NestedLoop" not in found._jdf.queryExecution().executedPlan().toString()


def test_overlaps_of_times_and_of_empty_tables(spark):
    t = datetime(2024, 1, 1)
    a = spark.createDataFrame([(1, t, t + timedelta(seconds=1)), (2, t, t + timedelta(days=900))], "i int, s timestamp, e timestamp")
    b = spark.createDataFrame([(1, t + timedelta(seconds=1), t + timedelta(seconds=2))], "j int, t timestamp_ntz, f timestamp_ntz")
    assert [(x.i, x.j) for x in intervals.overlap_join(a, b, ("s", "e"), ("t", "f")).collect()] == [(2, 1)]
    assert sorted((x.i, x.j) for x in intervals.overlap_join(a, b, ("s", "e"), ("t", "f"), closed=True).collect()) == [(1, 1), (2, 1)]
    assert intervals.overlap_join(a, b.limit(0), ("s", "e"), ("t", "f")).collect() == []
    with pytest.raises(ValueError, match="both sides"):
        intervals.overlap_join(a, a, ("s", "e"), ("s", "e"))
    with pytest.raises(ValueError, match="no bound"):
        intervals.overlap_join(a.withColumn("e", F.lit("x")), b, ("s", "e"), ("t", "f"))


def test_tasks_of_overlaps_follow_the_pairs(spark, monkeypatch):
    monkeypatch.setattr(intervals, "TASK_PAIRS", 2_000)
    a = spark.range(400).select("id", (F.col("id") % 40).alias("k"), F.lit(1.0).alias("s"))
    b = spark.range(400).select(F.col("id").alias("j"), (F.col("id") % 40).alias("k"), F.lit(0.0).alias("t"), F.lit(2.0).alias("f"))
    found = intervals.overlap_join(a, b, ("s", "s"), ("t", "f"), ["k"], closed=True)
    # 4,000 pairs that overlap are compared, and some that meet in bins twice
    assert found.rdd.getNumPartitions() > 1
    assert found.count() == found.distinct().count() == 4_000


def rows_that_meet(monkeypatch):
    """Filled by a join: rows of both sides for their bins, and for their blocks as well."""
    counts, split = [], intervals._split

    def counted(a, b, *rest):
        blocks = split(a, b, *rest)
        counts.extend(side.count() for side in (a, b, *blocks))
        return blocks

    monkeypatch.setattr(intervals, "_split", counted)
    return counts


@pytest.mark.parametrize("closed", [True, False])
def test_a_few_long_intervals_copy_no_short_ones(spark, monkeypatch, closed):
    counts = rows_that_meet(monkeypatch)
    r = random.Random(3)
    starts = [r.randint(0, 2_400) for _ in range(3_000)]
    left = [(i, float(s), float(s + 1 + i % 5)) for i, s in enumerate(starts)]
    right = [(i, float(s), float(s + r.randint(0, 20))) for i, s in enumerate(starts[:60])] + [(60, 0.0, 3_000.0)]
    a, b = spark.createDataFrame(left, "i int, s double, e double"), spark.createDataFrame(right, "j int, t double, f double")
    found = intervals.overlap_join(a, b, ("s", "e"), ("t", "f"), closed=closed)
    want = Counter((x[0], y[0]) for x in left for y in right if overlaps(x[1:], y[1:], closed))
    assert Counter((x.i, x.j) for x in found.collect()) == want
    # hardly more than once each; the long one is cut
    assert counts[0] < 1.5 * len(left) and counts[1] < 0.2 * len(left)


def test_blocks_of_few_pairs_are_not_copied(spark, monkeypatch):
    counts = rows_that_meet(monkeypatch)
    a = spark.range(900).select("id", F.lit(0.0).alias("s"))
    b = spark.range(2).select(F.col("id").alias("j"), F.lit(0.0).alias("t"))
    found = intervals.overlap_join(a, b, ("s", "s"), ("t", "t"), closed=True, crowded=30)
    assert found.count() == found.distinct().count() == 1_800
    # 900 rows in blocks of 300 at most, not of 30
    assert counts == [900, 2, 900, 6]


def test_pairs_come_in_the_order_of_their_bounds(spark, monkeypatch):
    monkeypatch.setattr(intervals, "TASK_PAIRS", 1_000)
    r = random.Random(4)
    a = spark.createDataFrame([(i, r.randint(0, 9)) for i in range(500)], "i int, s int").repartition(7)
    b = spark.createDataFrame([(j, 0, r.randint(7, 15)) for j in range(40)], "j int, t int, f int")
    # sides as large as to need blocks are not broadcast
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = intervals.overlap_join(a, b, ("s", "s"), ("t", "f"), closed=True)
        rows = found.select("s", "f", F.spark_partition_id().alias("task")).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(rows) > 9_000
    turns = sum(x.task == y.task and x.s > y.s for x, y in zip(rows, rows[1:]))
    # a block begins again at the least bound; in the order of arrival nearly every other row would
    assert turns < 60


@pytest.mark.parametrize("kind", ["date", "timestamp"])
def test_calendar_totals_count_gaps_as_time(spark, kind):
    r = random.Random(9)
    days = [date(2024, 1, 1) + timedelta(days=r.choice([0, 1, 5, 40, 400, 3_000, 9_000]) + r.randint(0, 200)) for _ in range(300)]
    data = [(r.choice(["a", "b", None]), d, r.choice([None, r.randint(1, 99)])) for d in days] + [("a", None, 5), ("a", None, 6)]
    df = spark.createDataFrame(data, "g string, d date, n int").withColumn("d", F.col("d").cast(kind))
    spec = Metric("m", "total", "level4.m.x.n", "cumulative_rolling", (Dimension("g"), Dimension("d", True)), rolling_days=90)
    sums = defaultdict(list)
    for g, d, n in data:
        sums[g, d].append(n)
    want = {}
    for g, d in sums:
        near = [n for (h, e), ns in sums.items() if h == g and ((d is None and e is None) or (d and e and 0 <= (d - e).days < 90)) for n in ns if n]
        want[g, d] = sum(near) if near else None
    found = metrics.compute(df, spec).collect()
    assert {(x.g, x.d.date() if kind == "timestamp" and x.d else x.d): x.total for x in found} == want


def test_rolling_periods_count_rows_once_or_twice(spark):
    data = [(g, i, i + 1) for g in "ab" for i in range(5_000)]
    df = spark.createDataFrame(data, "g string, t int, n long")
    spec = Metric("m", "total", "level4.m.x.n", "cumulative_rolling", (Dimension("g"), Dimension("t", True)), rolling_periods=30)
    found = {(x.g, x.t): x.total for x in metrics.compute(df, spec).collect()}
    assert found == {(g, i): sum(range(max(i - 28, 1), i + 2)) for g in "ab" for i in range(5_000)}
    assert Metric("m", "a", "level4.m.x.n", "sum").definition_hash != spec.definition_hash
    with pytest.raises(ValueError, match="one number"):
        Metric("m", "t", "level4.m.x.n", "cumulative_rolling", (Dimension("t", True),), rolling_periods=2, rolling_days=3)


@pytest.mark.parametrize("parts", [[], ["part"]])
def test_sorted_files_hardly_overlap(spark, folder, parts):
    r = random.Random(4)
    data = [(i, r.random() if i % 50 else None, r.choice("abcdefghij") * r.randint(1, 3), {"k": i}, i % 2) for i in range(4_000)]
    df = spark.createDataFrame(data, "i int, x double, s string, m map<string,int>, part int")
    writer = df.repartition(30).write.partitionBy(*parts) if parts else df.repartition(30).write
    writer.parquet(f"{folder}/t")
    size = maintenance.list_files(spark, f"{folder}/t").agg(F.sum("size_bytes")).first()[0]
    maintenance.compact(spark, f"{folder}/t", target_bytes=size // 16, strategy="sort", sort_columns=["x", "s"])
    stored = loads.read_table(spark, f"{folder}/t", df.schema)
    assert sorted(map(str, stored.collect())) == sorted(map(str, df.collect()))
    rows = stored.select("x", "s", "part", F.input_file_name().alias("f")).collect()
    files = defaultdict(list)
    for row in rows:
        files[row.f].append(row)
    assert 8 <= len(files) <= 24
    places = {v: n for n, v in enumerate(sorted({row.s for row in rows}))}
    xs = [[row.x for row in rows_ if row.x is not None] for rows_ in files.values()]
    ss = [[places[row.s] for row in rows_] for rows_ in files.values()]
    for values, whole in ((xs, 1.0), (ss, len(places) - 1)):
        assert sum(max(v) - min(v) for v in values) / len(values) < 0.65 * whole
    with pytest.raises(ValueError, match="sort columns"):
        maintenance.compact(spark, f"{folder}/t", strategy="sort")
    with pytest.raises(ValueError, match="unknown"):
        maintenance.compact(spark, f"{folder}/t", strategy="zorder")
