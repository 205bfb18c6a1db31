"""Raw file scans. Payloads are read by executors, never through the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ARTIFACT = "_artifact"
POSITION = "_position"


def scan_documents(
    spark: SparkSession, paths: str | list[str], schema: T.StructType | None = None
) -> DataFrame:
    """JSON documents, one per file; an array at the root gives one row per element.

    Adds the file path and the element's position, which identify a row without a
    shuffle. Without a schema the files are read once more to infer it. A file that is
    not JSON is an error; a file must fit into an executor's memory.
    """
    if schema is None:
        schema = spark.read.option("multiLine", True).json(paths).schema
    whole = spark.read.text(paths, wholetext=True).select(
        F.col("_metadata.file_path").alias(ARTIFACT), "value"
    )
    # ltrim keeps a byte-order mark; drop it before looking at the first character
    body = F.regexp_replace("value", "^\ufeff?\\s*", "")
    strict = {"mode": "FAILFAST"}
    parsed = F.when(
        F.startswith(body, F.lit("[")), F.from_json(body, T.ArrayType(schema), strict)
    ).otherwise(F.array(F.from_json(body, schema, strict)))
    rows = whole.select(ARTIFACT, F.posexplode(parsed).alias(POSITION, "doc"))
    return rows.select(ARTIFACT, POSITION, "doc.*")


def scan_csv(spark: SparkSession, paths: str | list[str], **options) -> DataFrame:
    """Header row, every column text, byte-order mark stripped from the first name."""
    df = spark.read.options(header=True, inferSchema=False, encoding="UTF-8", **options).csv(paths)
    return df.toDF(*[c.lstrip("\ufeff") for c in df.columns])


def undecodable_rows(df: DataFrame) -> DataFrame:
    """Rows whose text held bytes that are not UTF-8 (decoded as U+FFFD)."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    hits = [F.col(f"`{c}`").contains("\ufffd") for c in text]
    return df.filter(F.coalesce(F.greatest(F.lit(False), *hits), F.lit(False)))


def scan_json_lines(
    spark: SparkSession, paths: str | list[str], schema: T.StructType | str | None = None,
    broken: str | None = None,
) -> DataFrame:
    """One row per line. A broken line is an error, or goes whole into the column ``broken``."""
    reader = spark.read
    if broken is None:
        reader = reader.option("mode", "FAILFAST")
        return (reader.schema(schema) if schema else reader).json(paths)
    reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", broken)
    if schema is None:
        schema = reader.json(paths).schema
    elif isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    fields = [f for f in schema.fields if f.name != broken]
    return reader.schema(T.StructType([*fields, T.StructField(broken, T.StringType())])).json(paths)


def scan(spark: SparkSession, paths: str | list[str], payload_format: str) -> DataFrame:
    """Dispatch on the landed format."""
    if payload_format == "json":
        return scan_documents(spark, paths)
    if payload_format in ("jsonl", "ndjson"):
        return scan_json_lines(spark, paths)
    if payload_format == "csv":
        return scan_csv(spark, paths)
    if payload_format == "parquet":
        return spark.read.parquet(*([paths] if isinstance(paths, str) else paths))
    if payload_format in ("txt", "xml"):
        return spark.read.text(paths)
    raise ValueError(f"unknown payload format {payload_format!r}")


def expose_raw(
    spark: SparkSession, name: str, paths: str | list[str], payload_format: str
) -> DataFrame:
    """Raw files as a view, without a normalized table in between."""
    df = scan(spark, paths, payload_format)
    df.createOrReplaceTempView(name)
    return df
