"""Validated deliveries as CSV, TSV or JSON lines with a checksum manifest."""

from __future__ import annotations

import fnmatch
import json
import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lamina import storage
from lamina.session import scratch

FORMATS = ("csv", "tsv", "jsonl")
REPLACEMENT = (
    "versioned_delivery", "overwrite_in_place", "append_new_artifact", "partition_replace",
)
# Rows of one delivered file, so that each can be hashed as one value
ROWS_PER_FILE = 1_000_000


class ExportRefused(Exception):
    pass


@dataclass(frozen=True)
class Publish:
    domain: str
    name: str
    format: str = "csv"
    columns: tuple[str, ...] = ()  # empty: all
    path_template: str = "{domain}/{publish_name}.{output_extension}"
    replacement: str = "versioned_delivery"
    required_columns: tuple[str, ...] = ()
    allow_empty: bool = False
    max_rows: int | None = None
    order_by: tuple[str, ...] = ()
    compression: str | None = None
    partition_columns: tuple[str, ...] = ()
    owner: str | None = None
    dataset: str | None = None
    query: str | None = None

    def __post_init__(self):
        if self.format not in FORMATS:
            raise ValueError(f"{self.name}: unknown format {self.format!r}")
        if self.replacement not in REPLACEMENT:
            raise ValueError(f"{self.name}: unknown replacement mode {self.replacement!r}")
        if self.replacement == "partition_replace" and not self.partition_columns:
            raise ValueError(f"{self.name}: partition_replace needs partition columns")


def publish_from_dict(spec: Mapping, query: str | None = None) -> Publish:
    """A delivery from its manifest; ``source.selection_mode: query`` takes the SELECT beside it."""
    source, delivery = spec["source"], spec["delivery"]
    checks, by_query = spec.get("validation") or {}, source.get("selection_mode", "direct") == "query"
    if by_query and not (query or "").strip():
        raise ValueError(f"{spec['name']}: a query delivery needs query.sql")
    columns, required = tuple(spec.get("columns") or ()), tuple(checks.get("required_columns") or ())
    if columns and not set(required) <= set(columns):
        raise ValueError(f"{spec['name']}: required columns are not among the declared ones")
    packaging = (delivery.get("packaging") or {}).get("archive_format")
    if packaging:
        raise ValueError(f"{spec['name']}: archives are not written; use compression")
    return Publish(
        domain=spec["domain"].strip(),
        name=spec["name"].strip(),
        format=delivery["output_format"],
        columns=columns,
        path_template=delivery["path_template"],
        replacement=delivery.get("replacement_mode", "versioned_delivery"),
        required_columns=required,
        allow_empty=not checks.get("require_non_empty", True),
        compression=delivery.get("compression"),
        partition_columns=tuple(delivery.get("partition_columns") or ()),
        order_by=tuple(delivery.get("order_by") or ()),
        owner=(spec.get("owner") or {}).get("owner_team"),
        dataset=source["dataset"],
        query=query if by_query else None,
    )


def discover(package: str, pattern: str = "*") -> list[Publish]:
    """Deliveries under ``<package>/<domain>/<name>/`` whose folder matches the manifest."""
    found = []
    for manifest in sorted(Path(package).glob("*/*/manifest.*")):
        if manifest.suffix not in (".yaml", ".yml", ".json"):
            continue
        text, sql = manifest.read_text(encoding="utf-8"), manifest.parent / "query.sql"
        if manifest.suffix == ".json":
            spec = json.loads(text)
        else:
            import yaml

            spec = yaml.safe_load(text)
        one = publish_from_dict(spec, sql.read_text(encoding="utf-8") if sql.exists() else None)
        if (one.domain, one.name) != manifest.parent.parts[-2:]:
            raise ValueError(f"{manifest}: manifest says {one.domain}.{one.name}")
        if fnmatch.fnmatch(f"{one.domain}.{one.name}", pattern):
            found.append(one)
    return found


def deliver(
    spark: SparkSession,
    spec: Publish,
    read_dataset: Callable[[str], DataFrame],
    root: str,
    run_id: str,
    window_label: str | None = None,
    **options,
) -> DataFrame:
    """Publish what the delivery names: its dataset, or its SELECT over it."""
    df = read_dataset(spec.dataset)
    if spec.query:
        df.createOrReplaceTempView(spec.dataset)
        df = spark.sql(spec.query)
    return publish(df, spec, root, run_id, window_label, **options)


def render_path(spec: Publish, run_id: str, window_label: str | None = None) -> str:
    values = {
        "domain": spec.domain,
        "publish_name": spec.name,
        "run_id": run_id,
        "window_label": window_label or "open_window",
        "output_extension": spec.format,
    }
    unknown = set(re.findall(r"\{(.*?)\}", spec.path_template)) - values.keys()
    if unknown:
        raise ValueError(f"{spec.name}: unknown path fields {sorted(unknown)}")
    path = spec.path_template.format(**values)
    if path.startswith("/") or "://" in path or ".." in path.split("/"):
        raise ValueError(f"{spec.name}: the path must stay below the export root")
    return path


def plan_paths(spec: Publish, root: str, run_id: str, window_label: str | None = None) -> dict:
    """Where a run would write; reads nothing."""
    base, _, file_name = f"{root}/level5/{render_path(spec, run_id, window_label)}".rpartition("/")
    stable = {
        "versioned_delivery": None,
        "overwrite_in_place": f"{base}/{file_name}",
        "append_new_artifact": f"{base}/{file_name}.run_id={run_id}",
        "partition_replace": f"{base}/{file_name}",
    }[spec.replacement]
    return {"run": f"{base}/run_id={run_id}/{file_name}", "stable": stable}


def _write(
    df: DataFrame, spec: Publish, path: str, mode: str, partitions: Sequence[str] = (), single: bool = False
):
    if single:
        df = df.repartition(1).sortWithinPartitions(*spec.order_by) if spec.order_by else df.repartition(1)
    elif spec.order_by:
        # the staged copy has no order: part files follow it again, each is sorted within
        df = df.orderBy(*spec.order_by)
    writer = df.write.mode(mode).option("maxRecordsPerFile", ROWS_PER_FILE)
    if partitions:
        writer = writer.partitionBy(*partitions).option("partitionOverwriteMode", "dynamic")
    if spec.compression:
        writer = writer.option("compression", spec.compression)
    if spec.format == "jsonl":
        writer.option("ignoreNullFields", False).json(path)
        return
    separator = "\t" if spec.format == "tsv" else ","
    writer.options(header=True, sep=separator, escape='"', nullValue="", emptyValue="").csv(path)


def publish(
    df: DataFrame,
    spec: Publish,
    root: str,
    run_id: str,
    window_label: str | None = None,
    single_file: bool = False,
) -> DataFrame:
    """Write the delivery and return its manifest.

    The rows are computed and counted once into a staged copy; the ceiling and the
    other validations are decided on it, so a refused export leaves no delivery.
    """
    spark = df.sparkSession
    missing = [c for c in (*spec.columns, *spec.required_columns, *spec.order_by) if c not in df.columns]
    if missing:
        raise ExportRefused(f"{spec.name}: missing columns {missing}")
    if spec.columns:
        df = df.select(*spec.columns)
    if single_file and spec.max_rows is None:
        raise ExportRefused(f"{spec.name}: a single file needs a row ceiling")
    paths = plan_paths(spec, root, run_id, window_label)
    seen, stage = Observation(), scratch(spark, f"export-{spec.name}")
    try:
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(stage)
        rows = int(seen.get["rows"])
        if spec.max_rows is not None and rows > spec.max_rows:
            raise ExportRefused(f"{spec.name}: {rows} rows exceed the ceiling of {spec.max_rows}")
        if rows == 0 and not spec.allow_empty:
            raise ExportRefused(f"{spec.name}: no rows")
        ready = spark.read.schema(df.schema).parquet(stage)
        _write(ready, spec, paths["run"], "errorifexists", single=single_file)
        if spec.replacement == "partition_replace":
            _write(ready, spec, paths["stable"], "overwrite", spec.partition_columns, single_file)
        elif paths["stable"]:
            _write(ready, spec, paths["stable"], "overwrite", single=single_file)
    finally:
        storage.delete(spark, stage)
    context = {
        "run_id": run_id,
        "domain": spec.domain,
        "publish_name": spec.name,
        "replacement": spec.replacement,
        "window_label": window_label or "open_window",
        "owner": spec.owner,
        "total_rows": rows,
    }
    return manifest(spark, paths["run"], context)


def manifest(spark: SparkSession, path: str, context: Mapping[str, object]) -> DataFrame:
    """One row per delivered file: name, bytes and sha256, hashed by executors."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "part-*")
        .load(path)
    )
    extra = [F.lit(v).alias(k) for k, v in context.items()]
    return files.select(
        F.substring_index("path", "/", -1).alias("file_name"),
        F.col("length").alias("size_bytes"),
        F.sha2("content", 256).alias("sha256"),
        *extra,
    )
