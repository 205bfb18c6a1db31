"""Session defaults and the shared folder used for intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from lamina import storage

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "lamina", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``, or the checkpoint folder set
    on the context. Neither being set is an error, in every mode.
    """
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    configured = configured or spark.sparkContext.getCheckpointDir()
    if not configured:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return configured.rstrip("/")


_marked: set[str] = set()


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path below this application's part of the shared folder, deleted when it ends."""
    folder = f"{shared_root(spark)}/lamina-{spark.sparkContext.applicationId}"
    if folder not in _marked:
        storage.delete_on_exit(spark, folder)
        _marked.add(folder)
    return f"{folder}/{label}-{uuid.uuid4().hex[:12]}"


def staged(
    df: DataFrame, label: str, partition_columns: list[str] | None = None, codec: str | None = None
) -> DataFrame:
    """Write ``df`` to a table in the shared folder and read it back; ``codec`` is parquet's, by default the session's.

    Cuts the lineage and survives the loss of any executor.
    """
    path = scratch(df.sparkSession, label)
    writer = df.write.mode("errorifexists")
    if codec:
        writer = writer.option("compression", codec)
    if partition_columns:
        writer = writer.partitionBy(*partition_columns)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
