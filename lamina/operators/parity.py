"""Compare table versions: checksums, reports and differing rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.functions.hashing import table_checksum


def parity_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table: rows, order-insensitive checksum, sorted column names."""
    parts = [
        table_checksum(df).select(
            F.lit(name).alias("model_id"),
            "row_count",
            F.concat_ws(":", "hash_xor", "hash_sum").alias("checksum"),
            F.lit(",".join(sorted(df.columns))).alias("columns"),
        )
        for name, df in tables.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def compare_reports(left: DataFrame, right: DataFrame) -> DataFrame:
    """match, mismatch, missing_left or missing_right per table."""
    names = ["row_count", "checksum", "columns"]
    a = left.select("model_id", F.struct(*names).alias("left"))
    b = right.select("model_id", F.struct(*names).alias("right"))
    status = (
        F.when(F.col("left").isNull(), "missing_left")
        .when(F.col("right").isNull(), "missing_right")
        .when(F.col("left") == F.col("right"), "match")
        .otherwise("mismatch")
    )
    return a.join(b, "model_id", "full_outer").select(
        "model_id",
        F.col("left.row_count").alias("left_rows"),
        F.col("right.row_count").alias("right_rows"),
        status.alias("status"),
    )


def all_match(comparison: DataFrame) -> bool:
    return comparison.filter(F.col("status") != "match").isEmpty()


def row_differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows (with their multiplicity) present on one side only."""
    columns = sorted(left.columns)
    if columns != sorted(right.columns):
        raise ValueError("the two versions have different columns")
    both = left.select(*columns, F.lit(1).alias("__side")).unionByName(
        right.select(*columns, F.lit(-1).alias("__side"))
    )
    # equal rows cancel out; what is left stands on the side of its sign, as often
    surplus = both.groupBy(*columns).agg(F.sum("__side").alias("__n")).filter(F.col("__n") != 0)
    times = F.explode(F.sequence(F.lit(1).cast("bigint"), F.abs("__n")))
    side = F.when(F.col("__n") > 0, "left").otherwise("right").alias("side")
    return surplus.select(*columns, side, times.alias("__copy")).drop("__copy")
