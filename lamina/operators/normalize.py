"""From raw documents to run-scoped level-2 tables."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina import storage
from lamina.operators import relational
from lamina.session import scratch
from lamina.sources import landing

#: Tables written side by side.
TABLES_AT_ONCE = 4


def normalize(
    docs: DataFrame,
    root: str,
    *,
    source: str,
    entity: str,
    row_id: Column,
    run_id: str,
    ingest_date: str,
    partition: dict[str, str] | None = None,
    identity_columns: Sequence[str] = (),
) -> tuple[DataFrame, list[dict]]:
    """Write one level-2 table per nesting level; returns (mapping catalog, manifest rows).

    ``run_id`` is the ingest run. The documents are parsed and keyed once into the
    shared folder; every table then reads only the nested fields it needs from there.
    ``identity_columns`` serve the key only and are not written.
    """
    body = docs.drop(*identity_columns)
    specs = relational.plan_tables(entity, body.schema)
    version = relational.mapping_version(specs)
    keyed = docs.select(row_id.alias("__key"), *[f"`{c}`" for c in body.columns])
    stage = scratch(docs.sparkSession, f"normalize-{entity}")
    try:
        keyed.write.parquet(stage)
        stored = docs.sparkSession.read.schema(keyed.schema).parquet(stage)

        def write(spec: relational.TableSpec) -> dict:
            rows = relational.table_for(stored, spec, F.col("__key"))
            return landing.write_level2(
                relational.with_lineage(rows, source, ingest_date, run_id),
                root, source=source, entity=entity, table=spec.name, mapping_version=version,
                run_id=run_id, partition=partition,
            )

        # the tables' jobs run side by side: one table's last tasks do not hold up the next
        with ThreadPoolExecutor(max_workers=TABLES_AT_ONCE) as pool:
            manifests = list(pool.map(write, specs))
    finally:
        storage.delete(docs.sparkSession, stage)
    return relational.mapping_catalog(docs.sparkSession, source, entity, specs), manifests
