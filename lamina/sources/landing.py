"""Landed files and run-scoped tables with their manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina import storage
from lamina.functions.hashing import artifact_id
from lamina.functions.names import path_fragment


def land(df: DataFrame, path: str, payload_format: str) -> None:
    """Write a payload once; an existing path is refused."""
    writer = df.write.mode("errorifexists")
    if payload_format in ("json", "jsonl", "ndjson"):
        writer.json(path)
    elif payload_format == "csv":
        writer.option("header", True).option("escape", '"').csv(path)
    elif payload_format in ("txt", "xml"):
        writer.text(path)
    elif payload_format == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"unknown payload format {payload_format!r}")


def landed_manifest(
    spark: SparkSession, path: str, *, run_id: str, source: str, entity: str, payload_format: str
) -> DataFrame:
    """One row per landed file; content hashes are computed by executors."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "part-*")
        .load(path)
    )
    return files.select(
        artifact_id(F.lit(run_id), F.col("path")).alias("artifact_id"),
        F.lit(run_id).alias("run_id"),
        F.lit(source).alias("source_name"),
        F.lit(entity).alias("entity_name"),
        F.lit(payload_format).alias("payload_format"),
        F.col("path").alias("data_path"),
        F.col("length").alias("file_size_bytes"),
        F.sha2("content", 256).alias("content_hash"),
    )


#: Prefix of a data column whose name the directories of level 2 use.
DATA_PREFIX = "data__"


def level2_table_root(root: str, source: str, entity: str, table: str) -> str:
    return (
        f"{root}/level2/source={path_fragment(source)}"
        f"/entity={path_fragment(entity)}/table={path_fragment(table)}"
    )


def write_level2(
    df: DataFrame,
    root: str,
    *,
    source: str,
    entity: str,
    table: str,
    mapping_version: str,
    run_id: str,
    partition: dict[str, str] | None = None,
) -> dict:
    """One directory per table and run; a run is never written twice. Returns its manifest row.

    Data columns called ``run_id`` or ``mapping_version`` are stored as ``data__run_id`` and
    ``data__mapping_version``: the plain names are those of the directories.
    """
    parts = {"mapping_version": mapping_version, **(partition or {}), "run_id": run_id}
    path = "/".join(
        [level2_table_root(root, source, entity, table),
         *[f"{k}={path_fragment(v)}" for k, v in parts.items()]]
    )
    clash = sorted(({"mapping_version", "run_id"} | set(partition or {})) & set(df.columns) - set(partition or {}))
    if clash:
        # directory values would replace them on reading
        df = df.withColumnsRenamed({c: f"{DATA_PREFIX}{c}" for c in clash})
    seen = Observation()
    # a constant partition value lives in the directory name, not in the file
    body = df.drop(*[k for k in (partition or {}) if k in df.columns])
    body.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("errorifexists").parquet(path)
    return {"source_name": source, "entity_name": entity, "table_name": table,
            "run_id": run_id, "path": path, "rows_written": int(seen.get["rows"])}


def read_level2(
    spark: SparkSession, root: str, source: str, entity: str, table: str
) -> DataFrame:
    """All mapping versions, dates and runs of a table, columns merged by name.

    Replayed runs are all there; see ``operators.loads.latest_per_key``.
    """
    base = level2_table_root(root, source, entity, table)
    if not storage.has_files(spark, base):
        raise FileNotFoundError(f"no level-2 data for {source}.{entity}.{table}")
    reader = spark.read.option("mergeSchema", True).option("basePath", base)
    found = reader.parquet(base).schema
    # directory values are text, whatever they look like
    first = found.names.index("mapping_version")
    fields = [
        T.StructField(f.name, T.StringType()) if i >= first else f
        for i, f in enumerate(found.fields)
    ]
    return spark.read.option("basePath", base).schema(T.StructType(fields)).parquet(base)
