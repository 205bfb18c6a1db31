"""Embedding near-duplicates through a pivot-permutation index.

Every vector is described by the order of its nearest reference points (pivots). Each of its
first pivots has an inverted list that holds the vector; vectors that meet in a list and share
enough pivots are candidates, and candidates are verified by their cosine in double precision.

Lists are cut into tiles, and each pair of tiles of a list is one row of work. A pair of vectors
is looked at in the list of the first pivot both share, so it counts once although it meets in
several lists. Tiles send back sums and spanning links, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import Staged, components, smallest_reached

#: Reference points, how many of the nearest describe a vector, and how many a pair must share.
#: At cosine 0.93 in 64 dimensions all of 4,000 random pairs share two of eight.
PIVOTS, NEAREST, SHARED = 128, 8, 2
#: Vectors from which pivots are taken, and the cosine that two pivots taken from them stay below.
SAMPLE, APART = 8192, 0.7
#: Vectors in a tile, on average.
TILE = 512


def usable(vector) -> Column:
    """Whether a vector has a direction: not null, no null or non-finite component, not all zero."""
    big = F.lit(float("inf"))
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < big))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def spread(sample: np.ndarray, count: int) -> np.ndarray:
    """Unit rows of ``sample``, in its order, at a cosine below APART to all rows taken before.

    A crowd of near copies gives one pivot; with many, its members would order almost equal pivots by noise.
    """
    rows = _unit(sample)
    free, taken = np.ones(len(rows), dtype=bool), []
    while len(taken) < count and free.any():
        taken.append(int(free.argmax()))
        free &= rows @ rows[taken[-1]] < APART
        free[taken[-1]] = False
    return rows[taken]


def pivots(own: np.ndarray, size: int, count: int) -> np.ndarray:
    """Unit reference points of ``size`` dimensions: those of ``own``, then seeded random directions."""
    more = np.random.default_rng(size).normal(size=(count - len(own), size))
    points = np.concatenate([own.reshape(len(own), size), more])
    return points / np.linalg.norm(points, axis=1)[:, None]


def _unit(rows: np.ndarray) -> np.ndarray:
    rows = rows.astype(np.float64)
    rows = rows / np.abs(rows).max(axis=1)[:, None]  # neither over- nor underflow in the norm
    return rows / np.sqrt((rows * rows).sum(axis=1))[:, None]


def _described(classes: DataFrame, sample: dict[int, np.ndarray], count: int, nearest: int) -> DataFrame:
    """``classes`` (rep, label, weight, vector) with ``near``: its nearest pivots, nearest first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, np.ndarray] = {}
        for batch in batches:
            lists = batch.column(3)
            values, ends = lists.values.to_numpy(), lists.offsets.to_numpy()
            sizes = np.diff(ends)
            near = np.empty((len(lists), nearest), dtype=np.int16)
            for size in np.unique(sizes).tolist():
                if size not in known:
                    own = sample.get(size, np.empty((0, size)))
                    known[size] = pivots(own, size, count)
                at = np.flatnonzero(sizes == size)
                rows = values[ends[at][:, None] + np.arange(size)]
                near[at] = np.argsort(-(_unit(rows) @ known[size].T), axis=1, kind="stable")[:, :nearest]
            flat = pa.array(near.reshape(-1), pa.int16())
            starts = pa.array(np.arange(len(lists) + 1) * nearest, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.ListArray.from_arrays(starts, flat)], [*names, "near"]
            )

    names = ["rep", "label", "weight", "vector"]
    kinds = [f"{c} {classes.schema[c].dataType.simpleString()}" for c in names]
    return classes.select(*names).mapInArrow(run, ", ".join([*kinds, "near array<smallint>"]))


def _bits(near: np.ndarray, count: int) -> np.ndarray:
    """Sets of pivots as rows of 64-bit words."""
    flags = np.zeros((len(near), -(-count // 64) * 64), dtype=np.uint8)
    np.put_along_axis(flags, near, 1, axis=1)
    return np.packbits(flags, axis=1, bitorder="little").view("<u8")


class _Tile:
    def __init__(self, ids, weights, near, vectors, nearest: int, count: int):
        self.ids, self.weights = ids.to_numpy(), weights.to_numpy()
        self.bits = _bits(near.to_numpy().reshape(-1, nearest).astype(np.int64), count)
        self.unit = _unit(vectors.to_numpy().reshape(len(self.ids), -1))


def _links(a: _Tile, b: _Tile, same: bool, pivot: int, shared: int, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of verified links that belong to this pivot's list."""
    below = np.zeros(a.bits.shape[1] * 64, dtype=np.uint8)
    below[:pivot] = 1
    below = np.packbits(below, bitorder="little").view("<u8")
    common = np.zeros((len(a.ids), len(b.ids)), dtype=np.uint8)
    earlier = np.zeros(common.shape, dtype=bool)
    for word in range(a.bits.shape[1]):
        both = a.bits[:, word][:, None] & b.bits[:, word][None, :]
        common += np.bitwise_count(both)
        if below[word]:
            earlier |= (both & below[word]) != 0
    candidate = (common >= shared) & ~earlier
    if same:
        candidate &= np.arange(len(a.ids))[:, None] < np.arange(len(b.ids))[None, :]
    i, j = np.nonzero(candidate)
    found = np.empty(len(i), dtype=bool)
    for at in range(0, len(i), 1 << 16):
        part = slice(at, at + (1 << 16))
        found[part] = np.einsum("ij,ij->i", a.unit[i[part]], b.unit[j[part]]) >= least
    return i[found], j[found]


def _pairs(lists: DataFrame, count: int, nearest: int, shared: int, least: float) -> DataFrame:
    """(node, root, links): per tile pair, each linked vector's weighted links and a spanning link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = batch.columns
            for r in range(batch.num_rows):
                pivot, same = cols[0][r].as_py(), cols[1][r].as_py()
                a = _Tile(*(c[r].values for c in cols[2:6]), nearest, count)
                b = a if same else _Tile(*(c[r].values for c in cols[6:10]), nearest, count)
                i, j = _links(a, b, same, pivot, shared, least)
                if not len(i):
                    continue
                # a vector sits once in a list, so the two tiles have no id in common
                ids = a.ids if same else np.concatenate([a.ids, b.ids])
                shift = 0 if same else len(a.ids)
                links = np.bincount(i, weights=b.weights[j], minlength=len(ids))
                links += np.bincount(j + shift, weights=a.weights[i], minlength=len(ids))
                nodes, low = smallest_reached(ids[i], ids[j + shift])
                at = np.flatnonzero(links)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[at]), pa.array(low[np.searchsorted(nodes, ids[at])]), pa.array(links[at].astype(np.int64))],
                    ["node", "root", "links"],
                )

    return lists.mapInArrow(run, "node bigint, root bigint, links bigint")


def near_duplicates(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
    threshold: float = 0.93,
    count: int = PIVOTS,
    nearest: int = NEAREST,
    shared: int = SHARED,
) -> DataFrame:
    """One row (id, n_links, component_id, kept) per row of ``vectors``.

    Vectors of one label (not null) and one length link when their cosine is ``threshold`` or
    more and they share ``shared`` of their ``nearest`` nearest pivots of ``count``; links below
    the threshold are never reported. Equal vectors of a label are one class: they link with each
    other, and the class is compared once. ``n_links`` counts the other rows linked directly,
    ``component_id`` is the smallest id reachable. Rows without a usable vector, label or id have
    no links and are their own component; repeated rows count as rows of their own.

    The pivots come from a sample of the table (SAMPLE distinct vectors, smallest hash of the id),
    no two of them close to each other, topped up with random directions; all vectors are indexed.
    """
    vector = vectors[vector_column]
    rows = vectors.select(
        vectors[id_column].cast("bigint").alias("id"),
        vectors[label_column].alias("label"),
        F.when(usable(vector), vector).alias("vector"),
    )
    good = rows.where("id is not null and label is not null and vector is not null")
    classes = good.groupBy("label", "vector").agg(F.min("id").alias("rep"), F.count("*").alias("weight"))
    classes = Staged(classes, "classes", light=True).df
    first = classes.orderBy(F.xxhash64("rep"), "rep").select("vector").limit(SAMPLE).toArrow()
    sample: dict[int, list] = {}
    for r in first.column(0):
        row = r.values.to_numpy()
        sample.setdefault(len(row), []).append(row)
    own = {size: spread(np.stack(rows), count) for size, rows in sample.items()}
    described = _described(classes, own, count, nearest)
    entries = described.withColumn("size", F.size("vector")).withColumn("pivot", F.explode("near"))
    entries = Staged(entries, "entries")
    block = ["label", "size", "pivot"]
    tiles_of = entries.df.groupBy(*block).agg(F.ceil(F.count("*") / TILE).alias("tiles"))
    tiles = entries.df.join(tiles_of, block).groupBy(
        *block, "tiles", F.pmod(F.xxhash64("rep"), "tiles").alias("tile")
    )
    # one struct per vector keeps the lists of a tile in step
    tiles = tiles.agg(F.collect_list(F.struct("rep", "weight", "near", "vector")).alias("rows"))
    tiles = tiles.select(
        *block, "tiles", "tile",
        F.col("rows.rep").alias("ids"), F.col("rows.weight").alias("weights"),
        F.flatten("rows.near").alias("nears"), F.flatten("rows.vector").alias("vecs"),
    )
    tiles = Staged(tiles.where(F.size("ids") + F.col("tiles") > 2), "tiles").df
    packed = ["ids", "weights", "nears", "vecs"]
    left = tiles.withColumn("other", F.explode(F.sequence(F.col("tile"), F.col("tiles") - 1)))
    right = tiles.select(*block, F.col("tile").alias("other"), *[F.col(c).alias(f"{c}_b") for c in packed])
    lists = left.join(right, [*block, "other"]).select(
        "pivot", (F.col("tile") == F.col("other")).alias("same"), *packed, *[f"{c}_b" for c in packed]
    )
    found = Staged(_pairs(lists, count, nearest, shared, threshold), "found").df
    sums = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("node").alias("u"), F.col("root").alias("v")))
    classes = (
        classes.join(sums, classes["rep"] == sums["node"], "left").drop("node")
        .join(roots, F.col("rep") == F.col("node"), "left")
        .select(
            F.col("label").alias("l"), F.col("vector").alias("v"),
            (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n"),
            F.coalesce("root", "rep").alias("component"),
        )
    )
    rows = rows.join(classes, (F.col("label") == F.col("l")) & (F.col("vector") == F.col("v")), "left")
    linked = F.col("id").isNotNull()
    return rows.select(
        "id",
        F.when(linked, F.coalesce("n", F.lit(0))).otherwise(0).cast("bigint").alias("n_links"),
        F.when(linked, F.coalesce("component", "id")).alias("component_id"),
        F.col("id").eqNullSafe(F.when(linked, F.coalesce("component", "id"))).alias("kept"),
    )
