"""Differences by digest trees are those of a plain comparison, and read little."""

import pytest

from lamina.operators import digest_tree as tree
from lamina.operators import parity, ranges

SCHEMA = "a bigint, b string, x double, y string"


@pytest.fixture
def make(spark, folder):
    spark.sparkContext.setCheckpointDir(f"{folder}/shared")

    def write(rows, name, like=None, **shape):
        df = spark.createDataFrame(rows, SCHEMA)
        tree.write_version(df, f"{folder}/{name}", ["a", "b"], like=like and f"{folder}/{like}", **shape)
        return df

    return write


def rows_of(n):
    rows = [(i // 2 if i % 17 else None, "pq"[i % 2] if i % 5 else None, i / 4, "é" * (i % 3)) for i in range(n)]
    return rows + [(3, "p", 1.0, "same")] * 40 + [(None, None, None, None)] * 3


def compared(spark, folder, left, right):
    schema = left.schema
    found = tree.version_differences(spark, f"{folder}/l", f"{folder}/r", schema, ["a", "b"])
    want = parity.row_differences(left, right)
    assert sorted(map(str, found.collect())) == sorted(map(str, want.select(*found.columns).collect()))


@pytest.mark.parametrize("shape", [{"ranges": 1, "slices": 1}, {"ranges": 7, "slices": 4}, {"ranges": 50}])
def test_differences_are_those_of_a_plain_comparison(spark, folder, make, shape):
    rows = rows_of(400)
    left = make(rows, "l", **shape)
    stored = tree.read_version(spark, f"{folder}/l", left.schema)
    assert sorted(map(str, stored.collect())) == sorted(map(str, left.collect()))
    changed = [(a, b, x, y) if x != 10.0 else (a, b, x + 1, y) for a, b, x, y in rows if a != 77]
    changed += [(10_000, "new", 0.0, ""), (-5, None, 0.0, ""), rows[0], (3, "p", 1.0, "same")]
    right = make(changed, "r", like="l")
    compared(spark, folder, left, right)


def test_equal_versions_and_empty_ones(spark, folder, make):
    rows = rows_of(200)
    left, right = make(rows, "l", ranges=8), make(rows[::-1], "r", like="l")
    assert tree.unequal_nodes(spark, f"{folder}/l", f"{folder}/r").collect() == []
    compared(spark, folder, left, right)
    none = make([], "none", like="l")
    found = tree.version_differences(spark, f"{folder}/l", f"{folder}/none", left.schema, ["a", "b"])
    assert found.where("side = 'left'").count() == len(rows) == found.count()
    empty = make([], "empty")
    assert tree.version_differences(spark, f"{folder}/empty", f"{folder}/empty", none.schema, ["a", "b"]).collect() == []
    assert empty.schema == none.schema


def test_only_unequal_ranges_are_read(spark, folder, make):
    rows = [(i, "k", float(i), "") for i in range(2_000)]
    left = make(rows, "l", ranges=20)
    make([r if r[0] not in (500, 1_500) else (*r[:3], "x") for r in rows], "r", like="l")
    unequal = tree.unequal_nodes(spark, f"{folder}/l", f"{folder}/r").collect()
    assert len(unequal) == 2 and len({r[tree.RANGE] for r in unequal}) == 2
    assert all(0 < r.left_rows == r.right_rows < 10 for r in unequal)
    found = tree.version_differences(spark, f"{folder}/l", f"{folder}/r", left.schema, ["a", "b"])
    assert found.count() == 4
    plan = found._jdf.queryExecution().executedPlan().toString()
    ranges = ",".join(str(n) for n in sorted(r[tree.RANGE] for r in unequal))
    assert f"{tree.RANGE}#" in plan and plan.replace(" ", "").count(f"IN({ranges})") >= 2


def test_unlike_versions_are_refused(spark, folder, make):
    make(rows_of(100), "l", ranges=4)
    make(rows_of(300), "r", ranges=9)
    with pytest.raises(ValueError, match="different bounds"):
        tree.unequal_nodes(spark, f"{folder}/l", f"{folder}/r")
    with pytest.raises(ValueError, match="ranges are"):
        make([], "x", ranges=tree.MOST_RANGES + 1)
    with pytest.raises(ValueError, match="called"):
        tree.write_version(spark.range(3).withColumnRenamed("id", tree.SLICE), f"{folder}/y", [tree.SLICE])


def test_ranges_of_keys_are_looked_up_without_a_copy_of_the_bounds_per_row(spark, folder):
    keys = [None, *range(0, 400, 2)] * 3
    rows = spark.createDataFrame([(k,) for k in keys], "k int")
    ranges.find_bounds(rows, ["k"], 50, f"{folder}/bounds")
    lows = [low.k0 for low in ranges.read_bounds(spark, f"{folder}/bounds")]
    placed = ranges.with_range(rows.union(spark.createDataFrame([(-5,), (999,), (7,)], "k int")), "place", ["k"], f"{folder}/bounds")
    rank = lambda k: (k is not None, k or 0)
    for row in placed.collect():
        assert row.place == max(sum(rank(low) <= rank(row.k) for low in lows) - 1, 0)
    assert "NestedLoop" not in placed._jdf.queryExecution().executedPlan().toString()
