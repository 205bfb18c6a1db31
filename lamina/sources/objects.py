"""Object listings and the delta-sync decision against the state of earlier syncs."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina import storage
from lamina.functions.literals import literal

LISTING_SCHEMA = "key string, size_bytes bigint, modified timestamp"


def list_objects(
    spark: SparkSession, root: str, prefix: str = "", recursive: bool = True
) -> DataFrame:
    """Files below ``root/prefix`` with their key relative to ``root``; contents are not read.

    A missing prefix gives no rows.
    """
    start = f"{root}/{prefix}".rstrip("/")
    if not storage.exists(spark, start):
        return spark.createDataFrame([], LISTING_SCHEMA)
    files = spark.read.format("binaryFile")
    if recursive:
        files = files.option("recursiveFileLookup", True)
    base = storage.qualified(spark, root)
    listed = files.load(start).select(
        F.substr("path", F.lit(len(base) + 2)).alias("key"),
        F.col("length").alias("size_bytes"),
        F.col("modificationTime").alias("modified"),
    )
    return listed if recursive else listed.filter(~F.contains(
        F.substr("key", F.lit(len(prefix.strip("/")) + 2 if prefix else 1)), F.lit("/")
    ))


def first_objects(listing: DataFrame, max_objects: int) -> DataFrame:
    """The first ``max_objects`` keys in key order (a cap the caller asks for)."""
    return listing.orderBy("key").limit(max_objects)


def sync_decisions(
    listing: DataFrame, seen: DataFrame, last_synced_at: datetime | None, mode: str = "delta"
) -> DataFrame:
    """The listing plus ``should_sync``.

    ``seen`` holds (key, seen_size, seen_modified), one row per key. A key seen before
    is copied again when its size or modification time changed; an unseen key when it
    is newer than the last sync.
    """
    if mode == "full":
        return listing.withColumn("should_sync", F.lit(True))
    if mode != "delta":
        raise ValueError(f"unknown sync mode {mode!r}")
    state = seen.select("key", "seen_size", "seen_modified", F.lit(True).alias("__seen"))
    known = F.col("__seen").isNotNull()
    resized = F.col("seen_size") != F.col("size_bytes")
    touched = F.col("seen_modified") != F.col("modified")
    recorded = F.col("seen_size").isNotNull() | F.col("seen_modified").isNotNull()
    rule = (
        F.when(known & F.coalesce(resized, F.lit(False)), True)
        .when(known & F.coalesce(touched, F.lit(False)), True)
        .when(known & (F.col("modified").isNull() | recorded), False)
        .otherwise(_newer(last_synced_at, listing.schema["modified"].dataType))
    )
    return listing.join(state, "key", "left").select(*listing.columns, rule.alias("should_sync"))


def _newer(last_synced_at: datetime | None, dtype: T.DataType) -> Column:
    if last_synced_at is None:
        return F.lit(True)
    return F.col("modified").isNull() | (F.col("modified") > literal(last_synced_at, dtype))


def seen_after(seen: DataFrame, synced: DataFrame) -> DataFrame:
    """State with the synced objects upserted."""
    fresh = synced.select(
        "key",
        F.col("size_bytes").alias("seen_size"),
        F.col("modified").alias("seen_modified"),
    )
    return seen.join(fresh, "key", "left_anti").unionByName(fresh)


def last_synced_after(synced: DataFrame, before: datetime | None) -> DataFrame:
    """One row: newest modification time synced, else the earlier value."""
    newest = F.max("modified")
    dtype = synced.schema["modified"].dataType
    value = newest if before is None else F.coalesce(newest, literal(before, dtype))
    return synced.agg(value.alias("last_synced_at"))
