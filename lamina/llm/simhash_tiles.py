"""SimHash near-duplicates: exact fingerprint comparison in tiles, most tile pairs skipped.

Fingerprints are grouped into cells by the population counts of their four 16-bit words.
One differing bit changes one of these counts by one, so two fingerprints within ``radius``
bits lie in cells whose counts differ by ``radius`` in sum at most; all other tile pairs are
skipped unread. The remaining pairs are compared exactly with exclusive-or and bit counts.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lamina.llm.common import Staged, components, slices

SEED = 42
#: Distinct fingerprints in a tile, on average.
TILE = 512
#: Shingles hashed at a time, so that one text needs bounded memory beside its words.
BLOCK = 1 << 16
#: Counts of set bits in a 16-bit word: 0 to 16.
LEVELS = 17


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """64-bit SimHash of a whole UTF-8 text; 0 when it has no word.

    A-Z are lower-cased, words end at ASCII white space, repeated shingles count each time;
    a text of fewer words than ``shingle`` is one shingle. A bit is set when it is set in
    more than half of the shingles' XXH64 hashes.
    """
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
    ends = np.cumsum(lengths) - 1
    width = min(shingle, len(words))
    starts = (ends - lengths + 1)[: len(words) - width + 1].tolist()
    ends = ends[width - 1 :].tolist()
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, dtype=np.int64)
    for at in range(0, len(starts), BLOCK):
        part = [digest(joined[a:b], SEED) for a, b in zip(starts[at : at + BLOCK], ends[at : at + BLOCK])]
        bits = np.unpackbits(np.array(part, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    kept = (2 * ones > len(starts)).astype(np.uint8)
    return int(np.packbits(kept, bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, text_column: str, output: str, shingle: int = 3) -> DataFrame:
    """``docs`` with the fingerprint (long) in column ``output``; null texts count as empty."""
    names = docs.columns
    if output in names:
        raise ValueError(f"there is a column {output} already")
    at = names.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, at):
                texts = part.column(at).cast(pa.binary()).to_pylist()
                found = np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found.view(np.int64))], [*names, output])

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields]
    return docs.mapInArrow(run, ", ".join([*kinds, f"`{output}` bigint"]))


def _offsets(radius: int) -> list[int]:
    """Differences of the word counts that sum to ``radius`` at most, as cell distances in base 64."""
    steps = range(-radius, radius + 1)
    near = [d for d in itertools.product(steps, repeat=4) if sum(map(abs, d)) <= radius]
    return [sum(x * 64**k for k, x in enumerate(d)) for d in near]


def _cell():
    """Population counts of the four words, offset so that neighbours never borrow between digits."""
    counts = [F.bit_count(F.shiftrightunsigned("fp", 16 * k).bitwiseAND(F.lit(0xFFFF))) for k in range(4)]
    return sum((c.cast("bigint") + 20) * 64**k for k, c in enumerate(counts))


def _linked(probes: np.ndarray, home: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join everything within ``radius``: not all of them, but the same components."""
    left, right, meets = [], [], set()
    step = max(1, (1 << 20) // max(1, len(home)))
    for at in range(0, len(probes), step):
        part = probes[at : at + step]
        distance = np.bitwise_count(part[:, None] ^ home[None, :])
        near = distance <= radius
        rows = np.flatnonzero(near.any(axis=1))
        if not len(rows):
            continue
        first = near[rows].argmax(axis=1)
        left.append(part[rows])
        right.append(home[first])
        i, j = np.nonzero(near[rows])
        meets.update(np.unique(first[i] * len(home) + j).tolist())
    # tiles are small: join home fingerprints that share a probe
    parent = list(range(len(home)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for code in meets:
        a, b = root(code // len(home)), root(code % len(home))
        if a != b:
            parent[max(a, b)] = min(a, b)
    hung = [x for x in range(len(home)) if parent[x] != x]
    left.append(home[hung])
    right.append(home[[root(x) for x in hung]])
    u, v = np.concatenate(left), np.concatenate(right)
    apart = u != v
    return u[apart], v[apart]


def links(fps: DataFrame, radius: int = 3) -> DataFrame:
    """Links (u, v) that connect all distinct values of ``fps.fp`` within ``radius`` bits.

    Tiles hold about 512 fingerprints of one cell. The table of cells is bounded (17^4) and is
    the only thing broadcast; a crowded cell becomes many tiles, and each (tile, probing tile)
    pair is a row of its own, so no group grows with the data.
    """
    distinct = Staged(fps.select("fp").distinct().withColumn("cell", _cell()), "fingerprints", light=True)
    sizes = distinct.df.groupBy("cell").agg(F.ceil(F.count("*") / TILE).alias("tiles"))
    sizes = Staged(sizes, "cells", light=True).df
    tiles = (
        distinct.df.join(F.broadcast(sizes), "cell")
        .groupBy("cell", F.pmod(F.xxhash64("fp"), "tiles").alias("tile"))
        .agg(F.collect_list("fp").alias("fps"))
    )
    tiles = Staged(tiles, "tiles", light=True).df
    distinct.drop()
    near = F.array(*[F.lit(x).cast("bigint") for x in _offsets(radius)])
    probes = (
        tiles.withColumn("cell", F.explode(F.transform(near, lambda d: F.col("cell") + d)))
        .join(F.broadcast(sizes), "cell")
        .groupBy("cell", F.col("tile").alias("probe"), "tiles")
        .agg(F.flatten(F.collect_list("fps")).alias("probes"))
        .withColumn("tile", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("tiles") - 1)))
        .select("cell", "tile", "probes")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in zip(batch.column(0), batch.column(1)):
                u, v = _linked(
                    a.values.to_numpy().view(np.uint64), b.values.to_numpy().view(np.uint64), radius
                )
                if len(u):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"]
                    )

    pairs = probes.join(tiles, ["cell", "tile"]).select("probes", "fps")
    return pairs.mapInArrow(run, "u bigint, v bigint")


def _classes(fps: DataFrame, radius: int) -> DataFrame:
    """(fp, component_id, keeper): of each fingerprint its component's smallest id, and a fingerprint
    of the component that a row with this id has (the smallest)."""
    first = F.min(F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("fp"))).alias("first")
    lowest = fps.groupBy("fp").agg(first)
    roots = components(links(fps, radius)).select(F.col("node").alias("fp"), "root")
    lowest = lowest.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    groups = lowest.groupBy("root").agg(F.min("first").alias("lead"))
    found = lowest.select("fp", "root").join(groups, "root")
    return found.select("fp", F.col("lead.id").alias("component_id"), F.col("lead.fp").alias("keeper"))


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle: int = 3,
    radius: int = 3,
) -> DataFrame:
    """One row (id, fp, component_id) per row of ``docs``.

    ``component_id`` is the smallest id reachable over links of ``radius`` bits or fewer,
    the row's own included. Texts without a word have fingerprint 0 and link like any other.
    Rows with a null id take part by their text and get the smallest id of their component
    (null when it has none); repeated rows stay, an empty table gives an empty result.
    """
    narrow = docs.select(docs[id_column].alias("id"), docs[text_column].alias("text"))
    fps = Staged(with_fingerprint(narrow, "text", "fp", shingle).select("id", "fp"), "simhash").df
    classes = _classes(fps, radius).select("fp", "component_id")
    return fps.join(classes, "fp").select("id", "fp", "component_id")


def deduplicate(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle: int = 3,
    radius: int = 3,
) -> DataFrame:
    """The rows of ``docs`` that stay: one of each component, the one with the smallest id.

    Of several rows with that id the one with the smallest fingerprint and then text stays.
    """
    narrow = docs.select(docs[id_column].alias("id"), docs[text_column].alias("text"))
    fps = Staged(with_fingerprint(narrow, "text", "fp", shingle).select("id", "fp"), "simhash").df
    leads = _classes(fps, radius).where("fp = keeper")
    leads = leads.select(F.col("component_id").alias("__id"), F.col("fp").alias("__lead"))
    marked = with_fingerprint(docs, text_column, "__fp", shingle)
    same = (F.col("__fp") == F.col("__lead")) & F.col(id_column).eqNullSafe(F.col("__id"))
    kept = marked.join(leads, same)
    order = W.partitionBy("__lead", "__id").orderBy(text_column)
    kept = kept.withColumn("__row", F.row_number().over(order)).where("__row = 1")
    return kept.select(*docs.columns)


def hex_fingerprint(column):
    return F.lower(F.lpad(F.hex(column), 16, "0"))
