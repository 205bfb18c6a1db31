"""Hadoop file-system calls the load modes need (metadata only, no data)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _fs(spark, path)
    return fs.exists(hadoop_path)


def has_files(spark: SparkSession, path: str) -> bool:
    """True when ``path`` holds at least one data file at any depth."""
    fs, hadoop_path = _fs(spark, path)
    if not fs.exists(hadoop_path):
        return False
    files = fs.listFiles(hadoop_path, True)
    while files.hasNext():
        name = files.next().getPath().getName()
        if not name.startswith(("_", ".")):
            return True
    return False


def delete(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _fs(spark, path)
    fs.delete(hadoop_path, True)


def delete_on_exit(spark: SparkSession, path: str) -> None:
    """Make the folder and have it deleted when the application ends."""
    fs, hadoop_path = _fs(spark, path)
    fs.mkdirs(hadoop_path)
    fs.deleteOnExit(hadoop_path)


def partition_path(spark: SparkSession, path: str, names, values) -> str:
    """Directory of one partition; values are the texts that Spark's cast to string gives."""
    catalog = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog
    escape = catalog.ExternalCatalogUtils.escapePathName

    def text(value):
        return escape(value) if value else "__HIVE_DEFAULT_PARTITION__"

    return "/".join([path, *[f"{n}={text(v)}" for n, v in zip(names, values)]])


def qualified(spark: SparkSession, path: str) -> str:
    fs, hadoop_path = _fs(spark, path)
    return fs.makeQualified(hadoop_path).toString()
