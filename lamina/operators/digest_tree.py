"""Differences of two large stored versions of a table by trees of digests.

A version is stored in ranges of its key, one folder per range, with a tree of digests beside it: of
all rows, of groups of ranges, of ranges, and of slices of a range by the hash of the key. A later
version takes the bounds of the first, so that equal nodes hold equal rows. Two trees are compared
from the top; only children of unequal nodes are looked at, and only ranges with unequal slices
are read, of which only the rows of those slices are compared.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina import storage
from lamina.functions.hashing import row_hash
from lamina.operators.loads import read_table
from lamina.operators.parity import row_differences
from lamina.operators.ranges import MOST_RANGES, find_bounds, key_struct, read_bounds, with_range

RANGE, SLICE = "_range", "_slice"

#: Ranges of the first version, and slices of each range.
RANGES, SLICES = 256, 64

LEVELS = ("root", "group", "range", "slice")
DIGEST = ["rows", "hash_xor", "hash_sum"]
NODES = f"level string, grp int, {RANGE} int, {SLICE} int, rows bigint, hash_xor bigint, hash_sum decimal(38,0)"


def write_version(
    df: DataFrame, path: str, keys: Sequence[str], like: str | None = None, ranges: int = RANGES, slices: int = SLICES
) -> None:
    """Store ``df`` below ``path`` in ranges of ``keys`` with its tree of digests.

    ``like`` is the path of an earlier version whose bounds and slices are taken over. Keys may repeat
    and be null; a range in which one key has a large share of the rows is written by several tasks.
    """
    spark = df.sparkSession
    if {RANGE, SLICE} & set(df.columns):
        raise ValueError(f"columns may not be called {RANGE} or {SLICE}")
    if not 0 < ranges <= MOST_RANGES:
        raise ValueError(f"ranges are 1 to {MOST_RANGES}")
    if like is None:
        find_bounds(df, keys, ranges, f"{path}/bounds")
        spark.createDataFrame([(slices,)], "slices int").coalesce(1).write.parquet(f"{path}/shape")
    else:
        for part in ("bounds", "shape"):
            spark.read.parquet(f"{like}/{part}").coalesce(1).write.parquet(f"{path}/{part}")
    bounds, slices = read_bounds(spark, f"{path}/bounds"), spark.read.parquet(f"{path}/shape").first()[0]
    placed = with_range(df, RANGE, keys, f"{path}/bounds")
    # rebalancing splits large ranges over tasks and keeps the files of small ones few
    placed.hint("rebalance", F.col(RANGE)).write.partitionBy(RANGE).parquet(f"{path}/rows")
    rows = read_version(spark, path, df.schema, ranged=True)
    hashed = rows.select(
        RANGE, F.pmod(F.xxhash64(key_struct(keys)), F.lit(slices)).cast("int").alias(SLICE), row_hash(df).alias("h")
    )
    step = math.isqrt(max(len(bounds) - 1, 0)) + 1
    leaves = hashed.groupBy(RANGE, SLICE).agg(
        F.count(F.lit(1)).alias("rows"), F.bit_xor("h").alias("hash_xor"),
        F.sum(F.col("h").cast("decimal(38,0)")).alias("hash_sum"),
    ).withColumn("grp", F.floor(F.col(RANGE) / step).cast("int"))
    # one aggregation for all levels: the nodes above are sums of those below
    nodes = leaves.rollup("grp", RANGE, SLICE).agg(
        F.grouping_id().alias("g"), F.sum("rows").alias("rows"), F.bit_xor("hash_xor").alias("hash_xor"),
        F.sum("hash_sum").cast("decimal(38,0)").alias("hash_sum"),
    )
    level = F.when(F.col("g") == 7, "root").when(F.col("g") == 3, "group").when(F.col("g") == 1, "range").otherwise("slice")
    columns = [f.split()[0] for f in NODES.split(", ") if f.split()[0] != "level"]
    # at most ranges times slices small rows
    nodes = nodes.select(level.alias("level"), *columns).coalesce(1)
    nodes.write.partitionBy("level").parquet(f"{path}/tree")


def read_version(spark: SparkSession, path: str, schema: T.StructType, ranged: bool = False) -> DataFrame:
    """The rows of a stored version, with their range if asked."""
    stored = T.StructType([*schema.fields, T.StructField(RANGE, T.IntegerType())])
    rows = read_table(spark, f"{path}/rows", stored)
    return rows if ranged else rows.drop(RANGE)


def _nodes(spark: SparkSession, path: str, level: str) -> DataFrame:
    return spark.read.schema(NODES).parquet(f"{path}/tree").where(F.col("level") == level).drop("level")


def unequal_nodes(spark: SparkSession, left: str, right: str) -> DataFrame:
    """Slices (grp, _range, _slice) whose digests differ or that one version lacks, and both row counts.

    Levels are read from the top and only below unequal nodes, so equal versions cost two rows. Versions
    of different bounds or slices are refused.
    """
    if read_bounds(spark, f"{left}/bounds") != read_bounds(spark, f"{right}/bounds"):
        raise ValueError("the versions have different bounds; write one like the other")
    if spark.read.parquet(f"{left}/shape").first() != spark.read.parquet(f"{right}/shape").first():
        raise ValueError("the versions have different slices")
    names = ["grp", RANGE, SLICE]
    unequal = None
    for depth, level in enumerate(LEVELS):
        above = ["tree", *names[:depth]][:-1] if depth else []
        own = ["tree", *names[:depth]]
        sides = [_nodes(spark, path, level).withColumn("tree", F.lit(0)) for path in (left, right)]
        if depth:
            # never more than the version has nodes in a level
            below = F.broadcast(unequal.select(*above))
            sides = [side.join(below, above, "left_semi") for side in sides]
        a, b = (side.select(*own, F.struct(*DIGEST).alias(name)) for side, name in zip(sides, "ab"))
        unequal = a.join(b, own, "full_outer").where(~F.col("a").eqNullSafe(F.col("b")))
        if depth < len(names) and unequal.isEmpty():
            empty = ", ".join([*(f"{n} int" for n in names), "left_rows bigint", "right_rows bigint"])
            return spark.createDataFrame([], empty)
    left_rows, right_rows = (F.coalesce(F.col(f"{side}.rows"), F.lit(0)) for side in "ab")
    return unequal.select(*names, left_rows.alias("left_rows"), right_rows.alias("right_rows"))


def version_differences(
    spark: SparkSession, left: str, right: str, schema: T.StructType, keys: Sequence[str]
) -> DataFrame:
    """Rows (with their multiplicity) that one of two stored versions has more often, and the ``side``.

    Reads the folders of unequal ranges only; of their rows those of unequal slices are compared.
    """
    unequal = unequal_nodes(spark, left, right)
    slices = spark.read.parquet(f"{left}/shape").first()[0]
    # at most as many as the version has ranges
    touched = sorted(r[0] for r in unequal.select(RANGE).distinct().collect())

    def part(path: str) -> DataFrame:
        rows = read_version(spark, path, schema, ranged=True).where(F.col(RANGE).isin(touched))
        rows = rows.withColumn(SLICE, F.pmod(F.xxhash64(key_struct(keys)), F.lit(slices)).cast("int"))
        # one small row for each unequal slice
        found = rows.join(F.broadcast(unequal.select(RANGE, SLICE)), [RANGE, SLICE], "left_semi")
        return found.select(*[F.col(f"`{c}`") for c in schema.names])

    return row_differences(part(left), part(right))


def drop_version(spark: SparkSession, path: str) -> None:
    storage.delete(spark, path)
