"""Classification, masked views, retention and erasure."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina import storage
from lamina.functions.masks import mask, unmask_for
from lamina.operators.loads import load, read_table
from lamina.operators.skew import hot_hashes, lookup_join
from lamina.session import scratch

# weakest to strictest
TIERS = ("public", "internal", "confidential", "restricted_pii")
# fixed values: maskings a tier may use, and the one it gets by default
ALLOWED = {
    "public": {"none"},
    "internal": {"none", "truncate_end"},
    "confidential": {"hash_sha256", "truncate_middle", "truncate_end", "nullify"},
    "restricted_pii": {
        "hash_sha256", "redact_email", "redact_ssn", "truncate_middle", "nullify",
    },
}
DEFAULT = {"restricted_pii": "nullify", "confidential": "truncate_end"}


@dataclass(frozen=True)
class ColumnPolicy:
    name: str
    classification: str | None = None
    masking: str | None = None

    def __post_init__(self):
        if self.classification is not None and self.classification not in TIERS:
            raise ValueError(f"{self.name}: unknown classification {self.classification!r}")
        if self.masking is None:
            return
        if self.classification is None:
            raise ValueError(f"{self.name}: masking needs a classification")
        if self.masking not in ALLOWED[self.classification]:
            raise ValueError(f"{self.name}: {self.masking} is not allowed for {self.classification}")


def strictest(table: str | None, columns: Sequence[ColumnPolicy]) -> str | None:
    found = [c.classification for c in columns if c.classification]
    if table:
        found.append(table)
    return max(found, key=TIERS.index) if found else None


def effective(policy: ColumnPolicy, table: str | None = None) -> tuple[str | None, str]:
    """(classification, masking) of a column; its own setting beats the table's."""
    tier = policy.classification or table
    return tier, policy.masking or DEFAULT.get(tier, "none")


def masked_view(
    df: DataFrame,
    policies: Sequence[ColumnPolicy],
    table_classification: str | None = None,
    unmask_role: str | None = None,
    active_roles: Sequence[str] = (),
) -> DataFrame:
    """Every column under its masking; holders of ``unmask_role`` see the raw text.

    Columns without a policy follow the table's classification.
    """
    by_name = {p.name: p for p in policies}
    columns = []
    for name in df.columns:
        tier, strategy = effective(by_name.get(name, ColumnPolicy(name)), table_classification)
        value = F.col(name)
        if strategy != "none":
            value = unmask_for(value, mask(value, strategy, tier), unmask_role, set(active_roles))
        columns.append(value.alias(name))
    return df.select(*columns)


def table_properties(
    policies: Sequence[ColumnPolicy],
    classification: str | None = None,
    retention_days: int | None = None,
    owner: str | None = None,
) -> dict[str, str]:
    props = {
        "governance.classification": strictest(classification, policies),
        "governance.retention_days": None if retention_days is None else str(retention_days),
        "governance.owner": owner,
        "governance.columns": json.dumps(
            {p.name: dict(zip(("classification", "masking"), effective(p, classification)))
             for p in policies},
            sort_keys=True,
        ),
    }
    return {k: v for k, v in props.items() if v is not None}


def set_table_properties(spark: SparkSession, table: str, properties: Mapping[str, str]) -> None:
    """Errors surface; they are not swallowed."""
    def quoted(text):
        return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"

    pairs = ", ".join(f"{quoted(k)} = {quoted(v)}" for k, v in properties.items())
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({pairs})")


def expired(column: str, retention_days: int, reference: date) -> Column:
    """True for rows older than the retention period."""
    if retention_days <= 0:
        raise ValueError("retention_days must be positive")
    return F.col(column) < F.lit(reference - timedelta(days=retention_days))


def retain(df: DataFrame, column: str, retention_days: int, reference: date) -> DataFrame:
    """Rows within retention; on a partition column this prunes whole partitions."""
    return df.filter(~F.coalesce(expired(column, retention_days, reference), F.lit(False)))


def erase_where(df: DataFrame, conditions: Mapping[str, object]) -> DataFrame:
    """Drop the rows equal to all ``conditions`` (None matches null)."""
    return df.filter(~_equal_all(conditions))


def _equal_all(conditions: Mapping[str, object]) -> Column:
    if not conditions:
        raise ValueError("erasure needs at least one condition")
    hit = F.lit(True)
    for name, value in conditions.items():
        hit = hit & F.col(name).eqNullSafe(F.lit(value))
    return hit


def erase_ids(df: DataFrame, id_column: str, ids: DataFrame) -> DataFrame:
    """Drop rows whose id is listed; ``ids`` may be of any size, so no batches are needed."""
    listed = ids.select(F.col(ids.columns[0]).alias(id_column)).distinct()
    return lookup_join(df, listed, [id_column], "left_anti")


def erase_cascade(
    parent: DataFrame,
    children: Mapping[str, tuple[DataFrame, str]],
    id_column: str,
    ids: DataFrame,
    link: str,
) -> dict[str, DataFrame]:
    """Erase parents by id and every child row that points at an erased parent.

    ``link`` is the parent's column the children refer to; ``children`` maps a name to
    (rows, referring column).
    """
    listed = ids.select(F.col(ids.columns[0]).alias(id_column)).distinct()
    gone = lookup_join(parent, listed, [id_column], "left_semi")
    links = gone.select(link)
    out = {"parent": erase_ids(parent, id_column, ids)}
    for name, (rows, column) in children.items():
        out[name] = erase_ids(rows, column, links)
    return out


def delete_rows(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    gone: Callable[[DataFrame], DataFrame],
    kept: Callable[[DataFrame], DataFrame],
    partition_columns: Sequence[str] = (),
) -> int:
    """Delete rows from a stored table; returns their number.

    ``gone`` maps the table to the rows to delete and ``kept`` to all others; both filter it or join it by
    key. Rows are never compared as a whole, so columns of any type are allowed. Only partitions that hold rows
    to delete are read again and rewritten; those left empty are removed. When nothing is to be
    deleted nothing is written, so a run that is repeated changes nothing.
    """
    parts, folder = list(partition_columns), scratch(spark, "delete")
    table = read_table(spark, path, schema)
    try:
        # only the columns that decide, and one row per partition
        counts = gone(table).groupBy(*[F.col(c).alias(f"__{c}") for c in parts]).agg(F.count(F.lit(1)).alias("__n"))
        counts.write.parquet(f"{folder}/touched")
        touched = spark.read.schema(counts.schema).parquet(f"{folder}/touched")
        count = touched.agg(F.coalesce(F.sum("__n"), F.lit(0))).first()[0]
        if not count:
            return 0
        touched = touched.drop("__n")
        same = F.lit(True)
        for c in parts:
            same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
        rows = table.join(touched, same, "left_semi") if parts else table
        kept(rows).select(*[F.col(f"`{c}`") for c in schema.names]).write.parquet(f"{folder}/kept")
        left = read_table(spark, f"{folder}/kept", schema)
        if not parts:
            load(left, path, "full_refresh")
            return count
        load(left, path, "partition_overwrite", parts)
        empty = touched.join(left.select(*parts).distinct(), same, "left_anti")
        for row in empty.select(*[F.col(f"__{c}").cast("string") for c in parts]).toLocalIterator():
            storage.delete(spark, storage.partition_path(spark, path, parts, row))
        return count
    finally:
        storage.delete(spark, folder)


def delete_where(
    spark: SparkSession, path: str, schema: T.StructType, hit: Column, partition_columns: Sequence[str] = ()
) -> int:
    """Delete the rows of a stored table for which ``hit`` is true; where it is null they stay."""
    return delete_rows(
        spark, path, schema, lambda t: t.filter(hit), lambda t: t.filter(~F.coalesce(hit, F.lit(False))), partition_columns
    )


def apply_retention(
    spark: SparkSession, path: str, schema: T.StructType, column: str, retention_days: int,
    reference: date, partition_columns: Sequence[str] = (),
) -> int:
    """Delete rows older than the retention period from a stored table."""
    return delete_where(spark, path, schema, expired(column, retention_days, reference), partition_columns)


def apply_erasure_where(
    spark: SparkSession, path: str, schema: T.StructType, conditions: Mapping[str, object],
    partition_columns: Sequence[str] = (),
) -> int:
    """Delete the rows of a stored table that equal all ``conditions`` (None matches null)."""
    return delete_where(spark, path, schema, _equal_all(conditions), partition_columns)


def apply_erasure(
    spark: SparkSession, path: str, schema: T.StructType, id_column: str, ids: DataFrame,
    partition_columns: Sequence[str] = (),
) -> int:
    """Delete the rows of the listed ids from a stored table; rows without an id stay."""
    listed = ids.select(F.col(ids.columns[0]).alias(id_column)).distinct()
    # the few hot ids are looked for once, in the whole table
    hot = hot_hashes(read_table(spark, path, schema), [id_column])
    return delete_rows(
        spark, path, schema,
        lambda t: lookup_join(t, listed, [id_column], "left_semi", hot=hot),
        lambda t: lookup_join(t, listed, [id_column], "left_anti", hot=hot),
        partition_columns,
    )


@dataclass(frozen=True)
class StoredTable:
    path: str
    schema: T.StructType
    partition_columns: tuple[str, ...] = ()


def erase_stored_tree(
    spark: SparkSession, tables: Mapping[str, StoredTable], links: Sequence[tuple[str, str, str, str]],
    root: str, id_column: str, ids: DataFrame,
) -> dict[str, int]:
    """Delete ids from the stored table ``root`` and, level by level, all rows that refer to a deleted one.

    ``links`` holds (child table, its referring column, parent table, referred column), parents before their
    children; a table may refer to several parents. The keys of all levels are written down first, then the
    tables are rewritten from the last child to the root: a run that was broken off is repeated as a
    whole, since the parents that name the rest are still there. Returns the rows deleted by table.
    """
    folder = scratch(spark, "erase-tree")

    def noted(keys: DataFrame, name: str) -> DataFrame:
        keys.distinct().write.parquet(f"{folder}/{name}")
        return spark.read.schema(keys.schema).parquet(f"{folder}/{name}")

    def stored(name: str) -> DataFrame:
        return read_table(spark, tables[name].path, tables[name].schema)

    try:
        steps = [(root, id_column, noted(ids.select(F.col(ids.columns[0]).alias(id_column)), "ids"))]
        for n, (child, column, parent, referred) in enumerate(links):
            found = None
            for name, key, keys in steps:
                if name == parent:
                    gone = lookup_join(stored(parent), keys, [key], "left_semi")
                    gone = gone.select(F.col(referred).alias(column)).where(F.col(column).isNotNull())
                    found = gone if found is None else found.unionByName(gone)
            if found is None:
                raise ValueError(f"{child} comes before its parent {parent}")
            steps.append((child, column, noted(found, f"link-{n}")))
        counts = dict.fromkeys([name for name, _, _ in steps], 0)
        for name, key, keys in reversed(steps):
            t = tables[name]
            counts[name] += apply_erasure(spark, t.path, t.schema, key, keys, t.partition_columns)
        return counts
    finally:
        storage.delete(spark, folder)


def erase_tree(tables: Mapping[str, DataFrame], links: Sequence[tuple[str, str, str, str]],
               root: str, id_column: str, ids: DataFrame) -> dict[str, DataFrame]:
    """Erase ids from ``root`` and, level by level, every row that refers to an erased one.

    ``links`` holds (child table, its referring column, parent table, referred column), parents
    before their children.
    """
    listed = ids.select(F.col(ids.columns[0]).alias(id_column)).distinct()
    gone = {root: lookup_join(tables[root], listed, [id_column], "left_semi")}
    out = {root: erase_ids(tables[root], id_column, ids)}
    for child, column, parent, referred in links:
        if parent not in gone:
            raise ValueError(f"{child} comes before its parent {parent}")
        keys = gone[parent].select(F.col(referred).alias(column)).distinct()
        gone[child] = lookup_join(tables[child], keys, [column], "left_semi")
        out[child] = erase_ids(tables[child], column, keys)
    return {**tables, **out}
