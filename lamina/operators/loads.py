"""Load modes for path tables: full refresh, append, partition overwrite, upsert."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina import storage
from lamina.session import scratch

MODES = ("full_refresh", "append", "partition_overwrite")


@dataclass(frozen=True)
class LoadResult:
    path: str
    mode: str
    rows_written: int
    partition_columns: tuple[str, ...] = ()


def default_partitions(stage: str, mode: str, declared: Sequence[str] = ()) -> list[str]:
    """Declared columns if any; otherwise by stage. A full refresh is unpartitioned."""
    if declared:
        return list(declared)
    if mode == "full_refresh":
        return []
    return ["source_name", "business_date"] if stage == "level3" else ["business_date"]


def _write(df: DataFrame, path: str, save_mode: str, partition_columns: Sequence[str], **options):
    """Write and count in one job; no second read for the row count."""
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode(save_mode)
    if partition_columns:
        writer = writer.partitionBy(*partition_columns)
    writer.options(**options).parquet(path)
    return int(seen.get["rows"])


def clustered(df: DataFrame, partition_columns: Sequence[str]) -> DataFrame:
    """Group rows of one partition together so a write makes few files.

    The rebalance hint lets AQE split a partition value that holds many rows over
    several tasks and merge small ones.
    """
    return df.hint("rebalance", *partition_columns) if partition_columns else df


def load(
    df: DataFrame,
    path: str,
    mode: str = "full_refresh",
    partition_columns: Sequence[str] = (),
    validate: Callable[[DataFrame], None] | None = None,
) -> LoadResult:
    """Publish ``df`` at ``path``.

    With ``validate``, and whenever ``df`` reads files below ``path`` that this load replaces,
    the output is staged, checked by ``validate`` (which raises to refuse it), and only
    published from the staged copy. The row count is the number of rows written in this load.
    """
    if mode not in MODES:
        raise ValueError(f"unknown load mode {mode!r}")
    missing = [c for c in partition_columns if c not in df.columns]
    if missing:
        raise ValueError(f"partition columns {missing} are not in the output")
    if mode == "partition_overwrite" and not partition_columns:
        raise ValueError("partition_overwrite needs partition columns")
    if validate is None and (mode == "append" or not _reads(df, path)):
        return _publish(clustered(df, partition_columns), path, mode, partition_columns)
    spark, stage = df.sparkSession, scratch(df.sparkSession, "stage")
    try:
        clustered(df, partition_columns).write.parquet(stage)
        ready = read_table(spark, stage, df.schema)
        if validate:
            validate(ready)
        return _publish(ready, path, mode, partition_columns)
    finally:
        storage.delete(spark, stage)


def _reads(df: DataFrame, path: str) -> bool:
    """Whether the plan scans files at or below ``path``, or a folder that holds it."""
    target = storage.qualified(df.sparkSession, path).rstrip("/") + "/"
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if not leaf.getClass().getSimpleName().startswith("LogicalRelation"):
            continue
        relation = leaf.relation()
        if not relation.getClass().getSimpleName().startswith("HadoopFsRelation"):
            continue
        roots = relation.location().rootPaths()
        for j in range(roots.size()):
            root = storage.qualified(df.sparkSession, roots.apply(j).toString()).rstrip("/") + "/"
            if root.startswith(target) or target.startswith(root):
                return True
    return False


def publish_partitions(out: DataFrame, path: str, partition_columns: Sequence[str]) -> LoadResult:
    """Replace the partitions of ``out`` as they are dealt to tasks, without regrouping."""
    return _publish(out, path, "partition_overwrite", partition_columns)


def _publish(out: DataFrame, path: str, mode: str, partition_columns: Sequence[str]) -> LoadResult:
    if mode == "append":
        rows = _write(out, path, "append", partition_columns)
    elif mode == "full_refresh":
        rows = _write(
            out, path, "overwrite", partition_columns, partitionOverwriteMode="static"
        )
    else:
        rows = _write(
            out, path, "overwrite", partition_columns, partitionOverwriteMode="dynamic"
        )
    return LoadResult(path, mode, rows, tuple(partition_columns))


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read with the declared types, so partition values keep theirs (text stays text)."""
    return spark.read.schema(schema).parquet(path)


def latest_per_key(df: DataFrame, keys: Sequence[str], newest_first: Sequence[str]) -> DataFrame:
    """Keep one row per key, the newest by ``newest_first``.

    Spark limits each task to one row per key before the shuffle, so replays of a hot
    key do not pile up in one task.
    """
    order = [F.desc(c) for c in newest_first]
    ranked = df.withColumn("__rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("__rank") == 1).drop("__rank")


def union_evolved(parts: Sequence[DataFrame]) -> DataFrame:
    """Rows of all parts; a column a part lacks is null."""
    out = parts[0].select("*")
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    value_columns: Sequence[str] | None = None,
    partition_columns: Sequence[str] = (),
    *,
    update: bool = True,
    insert: bool = True,
    matched_condition: str | None = None,
    not_matched_condition: str | None = None,
) -> DataFrame:
    """The target after MERGE; conditions may name ``t`` and ``s``.

    Keys match by plain equality, so null keys never match. Without value columns only
    partition columns are updated. Several source rows for one matched key are an error
    when the result is computed. Target and source meet once, in one outer join; rows with
    a null key are spread over its tasks.
    """
    keys = list(keys)
    if not keys:
        raise ValueError("upsert needs key columns")
    if not update and not insert:
        raise ValueError("upsert needs an update or an insert branch")
    values = [c for c in (partition_columns if value_columns is None else value_columns)
              if c not in keys]
    carried = list(dict.fromkeys([*keys, *values, *partition_columns]))
    if not update:
        known = target.select(*keys).distinct()
        new = source.join(known, keys, "left_anti")
        if not_matched_condition:
            new = new.alias("s").filter(F.expr(not_matched_condition))
        return target.unionByName(new.select(*carried), allowMissingColumns=True).select(*target.columns)
    repeated = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > 1)
    old = _side(target, keys, "t")
    new = _side(source.join(repeated, keys, "left"), keys, "s")
    match = F.col("__tnull") == F.col("__snull")
    for k in keys:
        match = match & (F.col(f"__t_{k}") == F.col(f"__s_{k}"))
    joined = old.join(new, match, "full_outer" if insert else "left")
    there, here = F.col("t").isNotNull(), F.col("s").isNotNull()
    refused = F.raise_error(F.lit(f"several source rows match one target row on {keys}")).cast("boolean")
    joined = joined.filter(F.when(there & here & F.col("s.__n").isNotNull(), refused).otherwise(True))
    hit = there & here
    if matched_condition:
        hit = hit & F.coalesce(F.expr(matched_condition), F.lit(False))
    if not_matched_condition:
        wanted = F.coalesce(F.expr(not_matched_condition), F.lit(False))
        joined = joined.filter(there | wanted)
    columns = []
    for c in target.columns:
        fresh = F.col(f"s.{c}") if c in source.columns else F.lit(None)
        changed = F.when(hit, fresh).otherwise(F.col(f"t.{c}")) if c in values else F.col(f"t.{c}")
        first = fresh if c in carried else F.lit(None)
        columns.append(F.when(there, changed).otherwise(first).cast(target.schema[c].dataType).alias(c))
    return joined.select(*columns)


def _side(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Rows as one struct, their keys, and a number that spreads rows with a null key."""
    hashed = [f.name for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
    empty = F.lit(False)
    for k in keys:
        empty = empty | F.col(k).isNull()
    spread = F.when(empty, F.xxhash64(*hashed)).otherwise(F.lit(0)).alias(f"__{name}null")
    return df.select(F.struct(*df.columns).alias(name), *[F.col(k).alias(f"__{name}_{k}") for k in keys], spread)


def upsert_into(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    source: DataFrame,
    keys: Sequence[str],
    partition_columns: Sequence[str] = (),
    **options,
) -> LoadResult:
    """Upsert a parquet table in place, rewriting only the partitions it touches.

    A row whose partition value changes touches the old and the new partition. The touched
    partitions are a table that the target is joined to, so only they are read and no list
    of them is collected; folders of partitions that end up empty are deleted one by one.
    The partitions are replaced one after the other: readers may see some of them new and
    some old meanwhile.
    """
    values = options.pop("value_columns", [c for c in schema.names if c not in keys])
    parts = list(partition_columns)
    for c in parts:
        if isinstance(schema[c].dataType, T.StringType):
            # Spark stores an empty partition value as null
            source = source.withColumn(c, F.nullif(F.col(c), F.lit("")))
    if not storage.has_files(spark, path):
        empty = spark.createDataFrame([], schema)
        first = upsert(empty, source, keys, values, parts, **options)
        return load(first, path, "partition_overwrite" if parts else "full_refresh", parts)
    target = read_table(spark, path, schema)
    if not parts:
        merged = upsert(target, source, keys, values, parts, **options)
        return load(merged, path, "full_refresh")
    folder = scratch(spark, "upsert")
    try:
        # the batch is read several times: once from where it comes from
        source.write.parquet(f"{folder}/source")
        source = read_table(spark, f"{folder}/source", source.schema)
        hit = target.join(source.select(*keys).distinct(), list(keys), "left_semi")
        touched = hit.select(*parts).union(source.select(*parts)).distinct()
        touched.write.parquet(f"{folder}/touched")
        touched = read_table(spark, f"{folder}/touched", touched.schema)
        if touched.isEmpty():
            return LoadResult(path, "upsert", 0, tuple(parts))
        chosen = touched.select(*[F.col(c).alias(f"__{c}") for c in parts])
        same = F.lit(True)
        for c in parts:
            same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
        merged = upsert(target.join(chosen, same, "left_semi"), source, keys, values, parts, **options)
        clustered(merged, parts).write.parquet(f"{folder}/merged")
        ready = read_table(spark, f"{folder}/merged", merged.schema)
        filled = ready.select(*[F.col(c).alias(f"__{c}") for c in parts]).distinct()
        vacated = touched.join(filled, same, "left_anti")
        # Spark names a folder by the value's text
        vacated.select(*[F.col(c).cast("string") for c in parts]).write.parquet(f"{folder}/vacated")
        result = _publish(ready, path, "partition_overwrite", parts)
        text = T.StructType([T.StructField(c, T.StringType()) for c in parts])
        for row in read_table(spark, f"{folder}/vacated", text).toLocalIterator():
            storage.delete(spark, storage.partition_path(spark, path, parts, row))
    finally:
        storage.delete(spark, folder)
    return LoadResult(path, "upsert", result.rows_written, tuple(parts))


def late_partitions(table: DataFrame, batch: DataFrame, event_column: str) -> DataFrame:
    """All rows of the event partitions that the batch of new arrivals touches.

    Loading the result with ``partition_overwrite`` puts late rows into their event-day
    partition next to the rows that were already there; running it again changes nothing.
    """
    touched = batch.select(event_column).distinct()
    return table.join(touched, event_column, "left_semi").select(*table.columns)
