"""Ranges of a table's keys: bounds that part it evenly, and the range of each row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Every task that places rows gets all bounds, so there are about this many at most.
MOST_RANGES = 4096


def key_struct(columns: Sequence[str]) -> Column:
    return F.struct(*[F.col(f"`{c}`").alias(f"k{n}") for n, c in enumerate(columns)])


def find_bounds(df: DataFrame, keys: Sequence[str], ranges: int, path: str) -> None:
    """Write the keys that begin about ``ranges`` parts of equal size: each so many-th of the sorted keys.

    Tasks sort a range of the keys each, so there are as many tasks as the keys need, not one for each bound.
    """
    step = max(1, -(-df.count() // ranges))
    parts = df.select(key_struct(keys).alias("low")).repartitionByRange("low").sortWithinPartitions("low")
    # the row's place in its task
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    chosen = parts.withColumn("place", place).where(F.col("place") % step == 0)
    chosen.select("low").distinct().write.parquet(path)


def read_bounds(spark: SparkSession, path: str) -> list:
    return [r.low for r in spark.read.parquet(path).orderBy("low").select("low").collect()]


def with_range(df: DataFrame, name: str, keys: Sequence[str], path: str) -> DataFrame:
    """``df`` with the number of bounds up to each row's key, found by halving: some twelve comparisons a row.

    Keys below the first bound count to the first range; null is the least value.
    """
    stored = df.sparkSession.read.parquet(path)
    # at most MOST_RANGES and some bounds, which every task gets once, not every row
    lows = stored.agg(F.array_sort(F.collect_list("low"))).scalar()
    placed = df.withColumn("__key", key_struct(keys)).withColumn(name, F.lit(0))
    step = 1 << max(stored.count() - 1, 0).bit_length()
    while step := step >> 1:
        # struct comparison takes nulls as the least values; beyond the last bound there is none to compare with
        further = F.get(lows, F.col(name) + step) <= F.col("__key")
        placed = placed.withColumn(name, F.when(further, F.col(name) + step).otherwise(F.col(name)))
    return placed.drop("__key")
