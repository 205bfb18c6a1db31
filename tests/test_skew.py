"""Salted joins give the plain join's rows."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from lamina.operators import skew
from lamina.operators.skew import hot_hashes, lookup_join


@pytest.fixture(scope="module")
def sides(spark):
    # key 7 holds a third of the rows, key null some; many copies of equal rows
    left = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, 7)
        .when(F.col("id") % 100 == 1, F.lit(None))
        .otherwise(F.col("id") % 500)
        .cast("int")
        .alias("k"),
        (F.col("id") % 10).alias("v"),
    )
    right = spark.range(0, 400, 2).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    right = right.unionByName(
        spark.createDataFrame([(7, -7), (None, -1)], "k bigint, w bigint")
    )
    return left, right


def rows(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_salted_equals_plain(sides, how, null_safe):
    left, right = sides
    hot = hot_hashes(left, ["k"], hot_rows=1000)
    assert len(hot) == 1
    plain = lookup_join(left, right, ["k"], how, null_safe, hot=[])
    salted = lookup_join(left, right, ["k"], how, null_safe, hot=hot)
    assert rows(salted) == rows(plain)
    assert salted.columns == plain.columns


def test_hot_key_is_spread(sides):
    left, right = sides
    hot = hot_hashes(left, ["k"], hot_rows=1000)
    varied = left.withColumn("row", F.monotonically_increasing_id())
    plan = lookup_join(varied, right, ["k"], hot=hot)._jdf.queryExecution().toString()
    assert "__salt" in plan


def test_no_hot_keys_is_a_plain_join(spark):
    left = spark.range(1000).withColumnRenamed("id", "k")
    assert hot_hashes(left, ["k"]) == []
    plan = lookup_join(left, left, ["k"])._jdf.queryExecution().toString()
    assert "salt" not in plan


def test_negative_zero_and_types(spark):
    left = spark.createDataFrame([(0.0,)] * 50 + [(-0.0,)] * 50, "k double")
    right = spark.createDataFrame([(0, 1)], "k int, w int")
    hot = hot_hashes(left, ["k"], hot_rows=10)
    assert hot
    assert lookup_join(left, right, ["k"], "inner", hot=hot).count() == 100


@pytest.mark.parametrize("how", ["right", "full", "full_outer"])
def test_joins_that_keep_right_rows_are_refused(spark, how):
    with pytest.raises(ValueError):
        skew.lookup_join(spark.range(1), spark.range(1), ["id"], how)
