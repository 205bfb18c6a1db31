"""Small helpers the operators share: id hashing, staged tables, connected components."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina import storage
from lamina.session import scratch


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's sources to the executors, once per application.

    Workers then import the operators wherever they run; model state they cache lives in modules.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parent.parent
    target = Path(tempfile.mkdtemp(prefix="lamina-src-")) / f"{root.name}.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for source in sorted(root.rglob("*.py")):
            archive.write(source, source.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(target))
    _shipped.add(app)


#: Bytes of a column that a worker turns into Python objects at a time.
SLICE_BYTES = 4 << 20


def slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch with some megabytes of ``column`` each, one row at least.

    Batches hold up to 64 MB; working in parts keeps what a worker makes of them small. The
    column is text, binary or a list of 32-bit values.
    """
    values = batch.column(column)
    if pa.types.is_list(values.type):
        sizes = values.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) * 4
    else:
        sizes = pc.binary_length(values).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = np.cumsum(sizes) // SLICE_BYTES
    starts = np.flatnonzero(np.diff(part, prepend=-1))
    for start, end in zip(starts.tolist(), [*starts[1:].tolist(), batch.num_rows]):
        yield batch.slice(start, end - start)


def id_remainder(column, modulus: int):
    """crc32 of the id's decimal text modulo ``modulus``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % modulus


#: Has Spark delete the shuffle files of a query when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries that run in this block leave no shuffle files: their result is written, nothing reads them again."""
    usual = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, usual)


class Staged:
    """A table in the shared folder with its path, so that it can be deleted when no longer read.

    Uncompressed unless asked: most hold hashes, and each compressing writer keeps native buffers.
    ``light`` tables, which only shuffle and write little, are written by no more tasks than keep
    the cluster's cores busy a few times over.
    """

    def __init__(self, df: DataFrame, label: str, compression: str = "none", light: bool = False):
        self.spark: SparkSession = df.sparkSession
        self.path = scratch(self.spark, label)
        if light:
            df = df.coalesce(max(24, 4 * self.spark.sparkContext.defaultParallelism))
        with shuffles_removed(self.spark):
            df.write.mode("errorifexists").option("compression", compression).parquet(self.path)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        storage.delete(self.spark, self.path)


#: Links that one task joins at a time before any of them are shuffled.
CONTRACTED = 1 << 20


def smallest_reached(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, root): distinct nodes of the links and the smallest node of each one's component."""
    nodes, place = np.unique(np.concatenate([left, right]), return_inverse=True)
    i, j = place[: len(left)], place[len(left) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        new = new[new]
        if (new == root).all():
            return nodes, nodes[root]
        root = new


def _contracted(links: DataFrame) -> DataFrame:
    """Stars that connect what ``links`` (u, v) connect, for each task's links by themselves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def stars() -> pa.RecordBatch:
            left, right = (np.concatenate([b.column(k).to_numpy() for b in held]) for k in (0, 1))
            held.clear()
            nodes, root = smallest_reached(left, right)
            apart = nodes != root
            return pa.RecordBatch.from_arrays([pa.array(nodes[apart]), pa.array(root[apart])], ["u", "v"])

        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= CONTRACTED:
                yield stars()
        if held:
            yield stars()

    return links.select("u", "v").mapInArrow(run, "u bigint, v bigint")


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (u, v longs): one row (node, root) per linked node.

    ``root`` is the smallest node of the component. Tasks join the links they hold, then
    large-star and small-star steps alternate (every node is hung below the smallest neighbour)
    until the links are stars; each step is one written table in the shared folder, so no plan
    grows and a lost executor costs one step at most. Null ends and self-links are ignored; no
    links give an empty result.
    """
    links = edges.where("u is not null and v is not null and u <> v").select("u", "v")
    raw = Staged(links, "links")
    tasks = max(8, raw.spark.sparkContext.defaultParallelism)
    current, seen = Staged(_contracted(raw.df.coalesce(tasks)).distinct(), "links", light=True), None
    raw.drop()
    while True:
        mark = current.df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark[0] == 0 or mark == seen:
            return current.df.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = mark
        both = current.df.unionByName(current.df.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m"))
        lowest = lowest.select(F.col("u").alias("n"), F.least("u", "m").alias("m"))
        large = both.where("v > u").join(lowest, F.col("u") == F.col("n"))
        large = large.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = Staged(large, "links", light=True)
        lowest = large.df.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "n")
        small = large.df.join(lowest, F.col("u") == F.col("n"))
        small = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(lowest.select(F.col("n").alias("u"), F.col("m").alias("v")))
        following = Staged(small.distinct(), "links", light=True)
        large.drop()
        current.drop()
        current = following
