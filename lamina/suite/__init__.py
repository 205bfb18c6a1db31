"""Queries over the test tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Suite:
    """Collects queries and their SQL under a name."""

    def __init__(self):
        self.queries = {}
        self.oracles = {}

    def query(self, sql: str | None = None, name: str | None = None):
        def add(fn):
            key = name or fn.__name__
            self.queries[key] = fn
            if sql is not None:
                self.oracles[key] = sql
            return fn

        return add
