"""Nested documents to relational tables.

Every array becomes a child table linked by ``_parent_row_id``; structs become
prefixed columns. Keys are deterministic: a child's key is its parent's key plus its
position, so root and children can be computed in separate jobs, on a replay or after
a lost executor, and still agree. No step shuffles.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.functions.names import VALUE_COLUMN, NameRegistry

ROW_ID = "_row_id"
PARENT_ID = "_parent_row_id"
INDEX = "_array_index"
LINEAGE_COLUMNS = ("source_name", "ingest_date", "_run_id")


@dataclass
class TableSpec:
    """One output table: where it sits in the document and what it holds."""

    logical_path: str
    name: str
    parent: str | None
    arrays: tuple[tuple[str, ...], ...]  # array accessors from the document root down
    columns: list[tuple[str, tuple[str, ...], str]] = field(default_factory=list)

    def mapping(self) -> dict:
        return {
            "logical_path": self.logical_path,
            "physical_table_name": self.name,
            "parent_table_name": self.parent,
            "join_key_columns": [PARENT_ID] if self.parent else [],
            "column_mappings": [
                {"logical_path": path, "physical_name": name}
                for path, _, name in sorted(self.columns)
            ],
        }


def plan_tables(entity: str, schema: T.StructType, max_identifier: int = 63) -> list[TableSpec]:
    """Tables for ``schema``, parents before children."""
    tables: list[TableSpec] = []
    table_names = NameRegistry(max_identifier)

    def new_table(path: str, segments: list[str], parent: TableSpec | None, arrays) -> TableSpec:
        spec = TableSpec(
            path, table_names.claim(segments, path), parent.name if parent else None, arrays
        )
        tables.append(spec)
        return spec

    def add_fields(spec, names, fields, path, accessor):
        for f in fields:
            inner_path, inner = f"{path}.{f.name}", (*accessor, f.name)
            if isinstance(f.dataType, T.StructType):
                add_fields(spec, names, f.dataType.fields, inner_path, inner)
            elif isinstance(f.dataType, T.ArrayType):
                child = new_table(inner_path, [entity, *inner], spec, (*spec.arrays, inner))
                add_elements(child, f.dataType.elementType)
            else:
                spec.columns.append((inner_path, inner, names.claim(list(inner), inner_path)))

    def add_elements(spec, element):
        if isinstance(element, T.StructType):
            add_fields(spec, NameRegistry(), element.fields, spec.logical_path, ())
        else:
            spec.columns.append((f"{spec.logical_path}.{VALUE_COLUMN}", (), VALUE_COLUMN))

    root = new_table("$", [entity], None, ())
    add_fields(root, NameRegistry(), schema.fields, "$", ())
    return tables


def _reach(column: Column, accessor: tuple[str, ...]) -> Column:
    for part in accessor:
        column = column.getField(part)
    return column


def relationalize(
    df: DataFrame, entity: str, row_id: Column, max_identifier: int = 63
) -> dict[str, DataFrame]:
    """Flatten ``df``; ``row_id`` must identify a row (see ``document_key``).

    Each table is read straight from the document row, so tables written in separate
    jobs only scan the fields they need instead of replaying their parents.
    """
    specs = plan_tables(entity, df.schema, max_identifier)
    return {spec.name: table_for(df, spec, row_id) for spec in specs}


def table_for(df: DataFrame, spec: TableSpec, row_id: Column) -> DataFrame:
    if not spec.arrays:
        columns = [
            _reach(F.col(f"`{a[0]}`"), a[1:]).alias(name) for _, a, name in spec.columns
        ]
        return df.select(row_id.alias(ROW_ID), *columns)
    first, *deeper = spec.arrays
    array = _reach(F.col(f"`{first[0]}`"), first[1:])
    level = df.select(row_id.alias(PARENT_ID), F.posexplode(array).alias(INDEX, "__element"))
    for accessor in deeper:
        level = level.select(
            _child_id().alias(PARENT_ID),
            F.posexplode(_reach(F.col("__element"), accessor)).alias(INDEX, "__element"),
        )
    columns = [_reach(F.col("__element"), a).alias(name) for _, a, name in spec.columns]
    return level.select(_child_id().alias(ROW_ID), PARENT_ID, INDEX, *columns)


def _child_id() -> Column:
    return F.concat_ws("/", F.col(PARENT_ID), F.col(INDEX))


def document_key(*parts: Column) -> Column:
    """Row key from what identifies a document: artifact and position, or its natural key.

    Each part counts with its length, and a null is unlike any text. 128 bits of the digest:
    child tables repeat the key on every row, so its size counts.
    """
    marked = []
    for part in parts:
        text = part.cast("string")
        marked.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    digest = F.sha2(F.concat_ws("|", *marked), 256)
    return F.left(digest, F.lit(32))


def mapping_version(specs: list[TableSpec]) -> str:
    """Changes exactly when the structure changes."""
    text = json.dumps([s.mapping() for s in specs], sort_keys=True, separators=(",", ":"))
    return hashlib.sha256(text.encode()).hexdigest()[:16]


def mapping_catalog(
    spark: SparkSession, source: str, entity: str, specs: list[TableSpec]
) -> DataFrame:
    """One row per table and column; metadata only."""
    version = mapping_version(specs)
    rows = [
        (source, entity, version, s.logical_path, s.name, s.parent, path, name)
        for s in specs
        for path, _, name in sorted(s.columns)
    ]
    return spark.createDataFrame(
        rows,
        "source_name string, entity_name string, mapping_version string, table_path string,"
        " table_name string, parent_table string, column_path string, column_name string",
    )


def with_lineage(df: DataFrame, source: str, ingest_date: str, run_id: str) -> DataFrame:
    """Add the lineage columns that ``df`` lacks; ``run_id`` is the ingest run."""
    values = dict(zip(LINEAGE_COLUMNS, (source, ingest_date, run_id)))
    missing = {k: F.lit(v) for k, v in values.items() if k not in df.columns}
    return df.withColumns(missing)


def partition_values(
    strategy: str,
    manifest: dict,
    defaults: dict | None = None,
    metadata_key: str | None = None,
    partition_key: str = "source_key",
) -> dict[str, str]:
    """Constant partition columns of one normalize run."""
    known = {**(defaults or {}), **manifest.get("metadata", {})}
    if strategy == "none":
        return {}
    if strategy == "ingest_date":
        return {"ingest_date": str(manifest["ingest_date"])}
    if strategy == "business_date":
        if not known.get("business_date"):
            raise ValueError("business_date is neither in the manifest metadata nor a default")
        return {"business_date": str(known["business_date"])}
    if strategy == "source_key":
        wanted = metadata_key or partition_key
        if not known.get(wanted):
            raise ValueError(f"{wanted} is neither in the manifest metadata nor a default")
        return {partition_key: str(known[wanted])}
    raise ValueError(f"unknown partition strategy {strategy!r}")
