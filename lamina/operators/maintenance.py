"""Keep path tables compact: file listing, compaction, run expiry, orphan files."""

from __future__ import annotations

import re
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta
from itertools import islice

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina import storage
from lamina.functions.literals import literal
from lamina.operators.loads import LoadResult, load, publish_partitions
from lamina.operators.ranges import find_bounds, with_range
from lamina.session import scratch

MIN_INPUT_FILES = 5
TARGET_FILE_BYTES = 128 * 1024 * 1024
RUN_RETAIN_DAYS = 7
RUN_RETAIN_LAST = 1
ORPHAN_DAYS = 3


def list_files(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """(path, directory, size_bytes, modified); file contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(path)
    )
    return files.select(
        "path",
        F.regexp_extract("path", "^(.*)/[^/]+$", 1).alias("directory"),
        F.col("length").alias("size_bytes"),
        F.col("modificationTime").alias("modified"),
    )


def compaction_plan(
    files: DataFrame,
    min_input_files: int = MIN_INPUT_FILES,
    target_bytes: int = TARGET_FILE_BYTES,
) -> DataFrame:
    """Directories with enough small files to be worth rewriting, and how many files to aim for."""
    small = F.col("size_bytes") < target_bytes
    grouped = files.groupBy("directory").agg(
        F.count_if(small).alias("small_files"),
        F.sum(F.when(small, F.col("size_bytes")).otherwise(0)).alias("small_bytes"),
    )
    chosen = grouped.filter(F.col("small_files") >= min_input_files)
    return chosen.withColumn(
        "output_files", F.ceil(F.col("small_bytes") / target_bytes).cast("bigint")
    )


def layout(files: DataFrame, path: str) -> list[str]:
    """Partition columns that the directories of a table name; all files must agree."""
    below = F.substr("directory", F.lit(len(storage.qualified(files.sparkSession, path)) + 2))
    names = F.transform(
        F.filter(F.split(below, "/"), lambda x: x.contains("=")), lambda x: F.split_part(x, F.lit("="), F.lit(1))
    )
    found = files.select(names.alias("names")).distinct().limit(2).collect()
    if len(found) > 1:
        raise ValueError(f"{path}: files at different partition levels")
    return list(found[0]["names"]) if found else []


def compact(
    spark: SparkSession,
    path: str,
    partition_columns: Sequence[str] | None = None,
    min_input_files: int = MIN_INPUT_FILES,
    target_bytes: int = TARGET_FILE_BYTES,
    strategy: str = "binpack",
    sort_columns: Sequence[str] = (),
) -> LoadResult | None:
    """Rewrite the partitions the plan names into its number of files; None without any.

    Partition columns come from the table's directories; naming others is refused. Their
    values stay the text they are. The plan joins the table as a table, on the partition
    columns, so other partitions are not read; exactly the planned ones are replaced.

    ``binpack`` deals the rows to files by their hash. ``sort`` sorts them by ``sort_columns`` together (see
    ``interleaved``), so that each file of a partition covers a small part of every one of them.
    """
    if strategy not in ("binpack", "sort"):
        raise ValueError(f"unknown compaction strategy {strategy!r}")
    if (strategy == "sort") != bool(sort_columns):
        raise ValueError("sort takes sort columns, binpack none")
    files = list_files(spark, path)
    parts = layout(files, path)
    if partition_columns is not None and list(partition_columns) != parts:
        raise ValueError(f"{path}: partitioned by {parts}, not by {list(partition_columns)}")
    plan = compaction_plan(files, min_input_files, target_bytes)
    sample = plan.limit(1).collect()
    if not sample:
        return None
    body = spark.read.option("mergeSchema", True).parquet(sample[0]["directory"]).schema
    if parts:
        # the directories hold no partition column of their own
        whole = spark.read.option("mergeSchema", True).parquet(path).schema
        body = T.StructType([f for f in whole.fields if f.name not in parts])
    schema = T.StructType([*body.fields, *[T.StructField(c, T.StringType()) for c in parts]])
    rows = spark.read.schema(schema).parquet(path)
    wanted = plan.select("output_files", *[_partition_value(c).alias(f"__{c}") for c in parts])
    match = F.lit(True)
    for c in parts:
        match = match & F.col(c).eqNullSafe(F.col(f"__{c}"))
    if parts:
        rows = rows.join(wanted, match)
    else:
        rows = rows.withColumn("output_files", F.lit(plan.first()["output_files"]))
    if strategy == "sort":
        return _sorted(rows, path, schema, parts, sort_columns, plan)
    hashed = [f.name for f in body.fields if not isinstance(f.dataType, T.MapType)]
    spread = F.pmod(F.xxhash64(*hashed), F.greatest("output_files", F.lit(1)))
    rows = rows.withColumn("__file", spread).repartition(*parts, "__file").select(*schema.names)
    if not parts:
        return load(rows, path, "full_refresh", validate=lambda _: None)
    stage = scratch(spark, "compact")
    try:
        # staged in the layout it is published in, file by file
        rows.write.partitionBy(*parts).parquet(stage)
        ready = spark.read.schema(schema).parquet(stage)
        files_each = ready.select(*parts, F.col("_metadata.file_path").alias("__path"), *body.names)
        grouped = files_each.repartition(*parts, "__path").select(*schema.names)
        return publish_partitions(grouped, path, parts)
    finally:
        storage.delete(spark, stage)


#: Bits of each column in an interleaved key, and of the whole key.
COLUMN_BITS, KEY_BITS = 12, 62


def interleaved(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """``df`` with a number that sorts rows by several columns together (a Z-order).

    Each column is cut into about 4,096 ranges with equally many rows, so that its distribution and type do not
    matter; the bits of the ranges' numbers take turns, highest first. Null is the least value.
    """
    if not columns or len(set(columns)) < len(columns):
        raise ValueError("sort columns are given once each")
    spark, bits = df.sparkSession, min(COLUMN_BITS, KEY_BITS // len(columns))
    out, key = df, F.lit(0).cast("bigint")
    for turn, column in enumerate(columns):
        path, place = scratch(spark, "bounds"), f"__place{turn}"
        find_bounds(df, [column], 1 << bits, path)
        out = with_range(out, place, [column], path)
        # spread over all numbers, so that each bit halves the rows
        count = spark.read.parquet(path).count()
        out = out.withColumn(place, F.floor(F.col(place) * F.lit(1 << bits) / F.lit(max(count, 1))).cast("bigint"))
        for bit in range(bits):
            own = F.shiftright(F.col(place), bit).bitwiseAND(F.lit(1))
            key = key.bitwiseOR(F.shiftleft(own, bit * len(columns) + turn))
    return out.withColumn(name, key).drop(*[f"__place{turn}" for turn in range(len(columns))])


def _sorted(
    rows: DataFrame, path: str, schema: T.StructType, parts: Sequence[str], sort_columns: Sequence[str], plan: DataFrame
) -> LoadResult:
    """Rewrite ``rows`` in as many ranges of the interleaved key as the plan has files."""
    spark, stage = rows.sparkSession, scratch(rows.sparkSession, "compact")
    files = plan.agg(F.sum(F.greatest("output_files", F.lit(1)))).first()[0]
    keyed = interleaved(rows.select(*[F.col(f"`{c}`") for c in schema.names]), sort_columns, "__key")
    order = [*parts, "__key"]
    limit, usual = "spark.sql.codegen.hugeMethodLimit", spark.conf.get("spark.sql.codegen.hugeMethodLimit")
    try:
        # the lookups of several columns make one method that the JVM would not compile: Spark shall run them one by one
        spark.conf.set(limit, "8000")
        try:
            keyed.write.parquet(stage)
        finally:
            spark.conf.set(limit, usual)
        stored = T.StructType([*schema.fields, T.StructField("__key", T.LongType())])
        ready = spark.read.schema(stored).parquet(stage)
        ranged = ready.repartitionByRange(files, *order).sortWithinPartitions(*order).select(*schema.names)
        return publish_partitions(ranged, path, parts) if parts else load(ranged, path, "full_refresh")
    finally:
        storage.delete(spark, stage)


def _partition_value(name: str) -> Column:
    """Value of one partition column, from a directory's path as Spark escapes it."""
    raw = F.regexp_extract("directory", f"/{re.escape(name)}=([^/]*)", 1)
    text = F.url_decode(F.replace(raw, F.lit("+"), F.lit("%2B")))
    return F.when(raw != "__HIVE_DEFAULT_PARTITION__", text)


#: Deletions that are under way at a time, and paths that are held for them.
DELETING, HELD = 32, 1024


def remove_files(spark: SparkSession, files: DataFrame) -> int:
    """Delete the files a listing names (for example ``orphan_files``); returns their number.

    Paths stream to the driver in batches; the file system deletes many of a batch at once. Paths that
    are gone already count, so a run that was broken off can be repeated.
    """
    gone = 0
    paths = (row["path"] for row in files.select("path").where("path is not null").distinct().toLocalIterator())
    with ThreadPoolExecutor(DELETING) as pool:
        while batch := list(islice(paths, HELD)):
            gone += sum(1 for _ in pool.map(lambda path: storage.delete(spark, path), batch))
    return gone


def remove_runs(spark: SparkSession, runs: DataFrame, path_column: str = "path") -> int:
    """Delete the folders of superseded runs (for example ``expired_runs``); returns their number."""
    return remove_files(spark, runs.select(F.col(path_column).alias("path")).where("path is not null"))


def expired_runs(
    manifests: DataFrame,
    as_of: datetime,
    group: Sequence[str],
    run_column: str = "run_id",
    written_column: str = "written_at",
    retain_days: int = RUN_RETAIN_DAYS,
    retain_last: int = RUN_RETAIN_LAST,
) -> DataFrame:
    """Superseded runs: older than the limit and not among the newest of their group.

    Each task keeps at most ``retain_last`` runs per group before the shuffle, so a
    group with very many runs does not end up in one task.
    """
    keep = max(1, retain_last)
    newest = W.partitionBy(*group).orderBy(F.desc(written_column), F.desc(run_column))
    kept = manifests.withColumn("__rank", F.row_number().over(newest)).filter(
        F.col("__rank") <= keep
    )
    limit = as_of - timedelta(days=max(0, retain_days))
    dtype = manifests.schema[written_column].dataType
    old = manifests.filter(F.col(written_column) < literal(limit, dtype))
    return old.join(kept.select(*group, run_column), [*group, run_column], "left_anti")


def orphan_files(
    files: DataFrame, known: DataFrame, as_of: datetime, older_than_days: int = ORPHAN_DAYS
) -> DataFrame:
    """Files no manifest names, old enough not to belong to a running write."""
    limit = as_of - timedelta(days=max(1, older_than_days))
    old = files.filter(F.col("modified") < literal(limit, files.schema["modified"].dataType))
    return old.join(known.select("path"), "path", "left_anti")


def select_tables(
    spark: SparkSession,
    explicit: Sequence[str] = (),
    databases: Sequence[str] = (),
) -> list[str]:
    """Named tables and all tables of the given databases, once each, sorted."""
    names = set(explicit)
    for db in databases:
        names |= {f"{db}.{t.name}" for t in spark.catalog.listTables(db) if not t.isTemporary}
    return sorted(names)


def report(
    spark: SparkSession, paths: Sequence[str], min_input_files: int = MIN_INPUT_FILES
) -> DataFrame:
    """Dry run over several tables: per table the files seen and the partitions to rewrite."""
    parts = []
    for path in sorted(set(paths)):
        files = list_files(spark, path)
        plan = compaction_plan(files, min_input_files).withColumn("__p", F.lit(1))
        merged = files.groupBy("directory").agg(F.count(F.lit(1)).alias("n")).join(
            plan.select("directory", "__p"), "directory", "left"
        )
        parts.append(
            merged.agg(
                F.sum("n").alias("files"), F.count("__p").alias("partitions_to_compact")
            ).select(F.lit(path).alias("table"), "files", "partitions_to_compact")
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
