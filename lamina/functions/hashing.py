"""Row and table digests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_json(columns: Sequence[str]) -> Column:
    """The row as JSON text, columns in name order, null fields kept."""
    return F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"})


def row_md5(columns: Sequence[str]) -> Column:
    return F.md5(row_json(columns))


def artifact_id(run_id: Column, path: Column) -> Column:
    return F.substring(F.sha2(F.concat_ws(":", run_id, path), 256), 1, 24)


def row_hash(df: DataFrame) -> Column:
    """64-bit hash of the row, columns in name order; null positions change the hash."""
    parts = []
    for name in sorted(df.columns):
        value = F.col(f"`{name}`")
        parts.extend([value.isNull(), value.cast("string")])
    return F.xxhash64(*parts)


def table_checksum(df: DataFrame) -> DataFrame:
    """One row {row_count, hash_xor, hash_sum}; does not depend on row order.

    The xor alone cancels out pairs of equal rows, so the exact sum of the hashes
    goes with it. Both are partial aggregates: each task sends one row.
    """
    hashed = df.select(row_hash(df).alias("h"))
    return hashed.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.bit_xor("h").alias("hash_xor"),
        F.sum(F.col("h").cast("decimal(38,0)")).alias("hash_sum"),
    )
