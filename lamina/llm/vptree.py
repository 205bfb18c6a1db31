"""Nearest neighbours by largest inner product, with a vantage-point tree per shard.

Inner product is not a metric. Each shard adds one component to its vectors that gives all of
them the norm of its longest; queries get a zero there. Distances of the longer vectors then
order a query's neighbours as its inner products do, and the triangle inequality holds. The
pruning radius is divided by a factor: 1 searches exactly, more prunes more and may miss some.

Shards hold about as many vectors whatever the table's size. A shard's tree is one written row;
each (shard, block of queries) is one row of work that returns the best of the shard.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lamina.llm.common import Staged
from lamina.llm.pivot_dedup import usable

#: Vectors in a shard and queries in a block, on average; vectors in a leaf.
SHARD, BLOCK, LEAF = 8192, 1024, 256
#: Rounding slack of a distance, relative to the vectors' length.
SLACK = 1e-9


class Tree:
    """Vantage-point tree over rows of ``points`` (float64); ``order`` lists them leaf by leaf.

    Nodes are rows (vantage row, start, end, inner child, outer child) with the distance ranges
    of both children; a leaf has no children.
    """

    def __init__(self, points: np.ndarray):
        self.points = points
        self.order = np.arange(len(points))
        self.nodes: list[tuple] = []
        if len(points):
            self._build(0, len(points))

    def _distances(self, rows: np.ndarray, point: np.ndarray) -> np.ndarray:
        apart = self.points[rows] - point
        return np.sqrt(np.einsum("ij,ij->i", apart, apart))

    def _build(self, start: int, end: int) -> int:
        at = len(self.nodes)
        self.nodes.append((-1, start, end, -1, -1, 0.0, 0.0, 0.0, 0.0))
        if end - start <= LEAF:
            return at
        rows = self.order[start:end]
        # a far point of the part makes a vantage point that spreads the distances
        vantage = rows[self._distances(rows, self.points[rows].mean(axis=0)).argmax()]
        distances = self._distances(rows, self.points[vantage])
        split = np.argsort(distances, kind="stable")
        if distances[split[0]] == distances[split[-1]]:
            return at  # equal points stay in one leaf
        self.order[start:end], distances = rows[split], distances[split]
        half = (end - start) // 2
        ranges = distances[0], distances[half - 1], distances[half], distances[-1]
        inner = self._build(start, start + half)
        outer = self._build(start + half, end)
        self.nodes[at] = (int(vantage), start, end, inner, outer, *ranges)
        return at


class Search:
    """Best ``k`` rows for a block of queries: largest inner product, ties to the smaller id."""

    def __init__(self, ids, vectors, nodes, order, vantages, queries, query_ids, k: int, factor: float):
        self.k, self.factor = k, factor
        self.nodes, self.vantages = nodes, vantages
        # rows in the order of the leaves, so that a leaf is one contiguous block
        self.ids, self.vectors = ids[order], vectors[order]
        self.norms = np.einsum("ij,ij->i", vectors, vectors)
        self.longest = self.norms.max(initial=0.0)
        self.queries, self.query_ids = queries, query_ids
        self.query_norms = np.einsum("ij,ij->i", queries, queries)
        self.best: list[list[tuple[float, int]]] = [[] for _ in query_ids]
        self.worst = np.full(len(query_ids), -np.inf)
        self.worst_id = np.full(len(query_ids), np.iinfo(np.int64).max)
        self.slack = SLACK * (1 + np.sqrt(self.longest * self.query_norms))

    def run(self) -> None:
        if len(self.nodes):
            self._visit(0, np.arange(len(self.query_ids)))

    def _reach(self, q: np.ndarray) -> np.ndarray:
        """Distance within which a query may still find something better or as good."""
        squared = self.query_norms[q] + self.longest - 2 * (self.worst[q] - self.slack[q])
        return np.sqrt(np.maximum(squared, 0)) / self.factor

    def _visit(self, node: int, q: np.ndarray) -> None:
        if not len(q):
            return
        vantage, start, end, inner, outer, in_low, in_high, out_low, out_high = self.nodes[node]
        if inner < 0:
            for at in range(start, end, 4 * LEAF):
                self._leaf(at, min(end, at + 4 * LEAF), q)
            return
        point = self.vantages[node]
        squared = self.query_norms[q] + self.longest - 2 * (self.queries[q] @ point)
        distance = np.sqrt(np.maximum(squared, 0))
        near = distance <= (in_high + out_low) / 2
        gaps = {
            inner: np.maximum(np.maximum(in_low - distance, distance - in_high), 0),
            outer: np.maximum(np.maximum(out_low - distance, distance - out_high), 0),
        }
        for child, mine in ((inner, near), (outer, ~near), (inner, ~near), (outer, near)):
            part = q[mine]
            # gaps are rounded, too: allow for that
            open_ = gaps[child][mine] <= self._reach(part) + np.sqrt(self.slack[part])
            self._visit(child, part[open_])

    def _leaf(self, start: int, end: int, q: np.ndarray) -> None:
        vectors, ids = self.vectors[start:end], self.ids[start:end]
        rough = self.queries[q] @ vectors.T
        i, j = np.nonzero(rough >= (self.worst[q] - self.slack[q])[:, None])
        if not len(i):
            return
        own = self.query_ids[q[i]] == ids[j]
        i, j = i[~own], j[~own]
        # products are added one after the other: equal vectors get equal scores everywhere
        score = np.empty(len(i))
        for at in range(0, len(i), 1 << 15):
            part = slice(at, at + (1 << 15))
            products = self.queries[q[i[part]]] * vectors[j[part]]
            score[part] = np.add.accumulate(products, axis=1)[:, -1]
        worst, worst_id = self.worst[q[i]], self.worst_id[q[i]]
        better = (score > worst) | ((score == worst) & (ids[j] < worst_id))
        i, j, score = i[better], j[better], score[better]
        for row in np.unique(i).tolist():
            mine = slice(np.searchsorted(i, row), np.searchsorted(i, row, "right"))
            at = int(q[row])
            merged = [*self.best[at], *zip((-score[mine]).tolist(), ids[j[mine]].tolist())]
            merged.sort()
            self.best[at] = merged[: self.k]
            if len(merged) >= self.k:
                self.worst[at], self.worst_id[at] = -self.best[at][-1][0], self.best[at][-1][1]


def _matrix(scalar, size: int) -> np.ndarray:
    return scalar.values.to_numpy().astype(np.float64).reshape(-1, size)


def _lengthened(vectors: np.ndarray) -> np.ndarray:
    """One more component that gives all rows the norm of the longest."""
    norms = np.einsum("ij,ij->i", vectors, vectors)
    return np.column_stack([vectors, np.sqrt(np.maximum(norms.max(initial=0.0) - norms, 0))])


def build(shards: DataFrame) -> DataFrame:
    """``shards`` (size, shard, ids, flat) with the tree's nodes, and its rows in leaf order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                size = batch.column(0)[r].as_py()
                ids = batch.column(2)[r].values.to_numpy()
                first = np.argsort(ids, kind="stable")
                ids, vectors = ids[first], _matrix(batch.column(3)[r], size)[first]
                tree = Tree(_lengthened(vectors))
                nodes = np.array(tree.nodes, dtype=np.float64).reshape(-1, 9)
                place = np.empty(len(ids), dtype=np.int64)
                place[tree.order] = np.arange(len(ids))
                # vantage points by their place in leaf order
                inner = nodes[:, 3] >= 0
                nodes[inner, 0] = place[nodes[inner, 0].astype(np.int64)]
                flat = vectors[tree.order].reshape(-1)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(r, 1),
                        batch.column(1).slice(r, 1),
                        pa.array([ids[tree.order]], pa.list_(pa.int64())),
                        pa.array([flat], pa.list_(pa.float64())),
                        pa.array([nodes.reshape(-1)], pa.list_(pa.float64())),
                    ],
                    ["size", "shard", "ids", "flat", "nodes"],
                )

    return shards.select("size", "shard", "ids", "flat").mapInArrow(
        run, "size int, shard bigint, ids array<bigint>, flat array<double>, nodes array<double>"
    )


def _searched(work: DataFrame, k: int, factor: float) -> DataFrame:
    """(query_id, vec_id, score): the best ``k`` of each shard for each query of a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                size = batch.column(0)[r].as_py()
                ids = batch.column(1)[r].values.to_numpy()
                vectors = _matrix(batch.column(2)[r], size)
                nodes = batch.column(3)[r].values.to_numpy().reshape(-1, 9)
                query_ids = batch.column(4)[r].values.to_numpy()
                queries = _matrix(batch.column(5)[r], size)
                table = [(*map(int, row[:5]), *row[5:]) for row in nodes.tolist()]
                # a query's added component is 0, so that of the vantage point never matters
                points = [vectors[row[0]] for row in table]
                search = Search(
                    ids, vectors, table, np.arange(len(ids)), points, queries, query_ids, k, factor
                )
                search.run()
                counts = [len(b) for b in search.best]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(query_ids, counts), pa.int64()),
                        pa.array([x[1] for b in search.best for x in b], pa.int64()),
                        pa.array([-x[0] for b in search.best for x in b], pa.float64()),
                    ],
                    ["query_id", "vec_id", "score"],
                )

    return work.mapInArrow(run, "query_id bigint, vec_id bigint, score double")


def _packed(rows: DataFrame, per_group: int, name: str, ids: str, flat: str) -> DataFrame:
    """Rows (id, vector, size) in groups of about ``per_group`` by a hash of the id."""
    groups = rows.groupBy("size").agg(F.ceil(F.count("*") / per_group).alias(f"{name}s"))
    rows = rows.join(groups, "size").withColumn(name, F.pmod(F.xxhash64("id", "vector"), f"{name}s"))
    rows = rows.groupBy("size", f"{name}s", name).agg(F.collect_list(F.struct("id", "vector")).alias("rows"))
    vectors = F.transform(F.flatten("rows.vector"), lambda x: x.cast("double"))
    return rows.select("size", f"{name}s", name, F.col("rows.id").alias(ids), vectors.alias(flat))


def search(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    k: int = 20,
    every: int = 20,
    factor: float = 1.0,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows with the largest inner product, nearest first.

    Queries are the rows whose id is divisible by ``every``; candidates are all rows with another
    id and the same number of components. Scores are inner products of the stored vectors in
    double precision, ties go to the smaller id. Null, zero and non-finite vectors and null ids
    take no part. Rows that repeat an id and vector are one query and one candidate; an id with
    several vectors is several of either.
    """
    vector = vectors[vector_column]
    rows = vectors.select(vectors[id_column].cast("bigint").alias("id"), vector.alias("vector"))
    rows = rows.where(F.col("id").isNotNull() & usable(F.col("vector"))).distinct()
    rows = Staged(rows.withColumn("size", F.size("vector")), "vectors").df
    trees = Staged(build(_packed(rows, SHARD, "shard", "ids", "flat")), "trees").df
    queries = _packed(rows.where(F.col("id") % every == 0), BLOCK, "block", "query_ids", "queries")
    queries = Staged(queries, "queries").df
    shards = trees.select("size", "shard")
    # pairs of (shard, block) are named first, then both sides travel to them
    blocks = queries.select("size", "block").join(shards, "size")
    work = blocks.join(trees, ["size", "shard"]).join(queries, ["size", "block"])
    # spread the rows of work: each is some megabytes and takes about a second
    work = work.repartition("size", "shard", "block")
    work = work.select("size", "ids", "flat", "nodes", "query_ids", "queries")
    found = _searched(work, k, factor)
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return found.select("query_id", "rank", "vec_id", "score")
