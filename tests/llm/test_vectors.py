"""Embedding operators against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lamina.llm import pivot_dedup, vptree
from lamina.llm.common import components, smallest_reached

SCHEMA = "vec_id long, embedding array<float>, label int, id string, links int, score double"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 0.5) for r in rows], SCHEMA)


def clustered(seed, n, size=16, spread=0.08):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(n // 6, size))
    rows = centres[rng.integers(0, len(centres), n)] + spread * rng.normal(size=(n, size))
    return rows.astype(np.float32)


ODD = [
    (None, [1.0] * 4, 0), (900, None, 0), (901, [0.0] * 4, 0), (902, [1.0, None, 0.0, 0.0], 0),
    (903, [1.0, float("nan"), 0.0, 0.0], 0), (904, [float("inf"), 0.0, 0.0, 0.0], 0), (905, [1.0] * 4, None),
    (906, [], 0), (907, [1e-30] * 4, 0), (908, [1e30] * 4, 0), (909, [2.0] * 4, 0), (909, [2.0] * 4, 0), (910, [1.0, 2.0], 0),
]


def good(row):
    v = row[1]
    return row[0] is not None and bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)


def brute_links(rows, threshold=0.93):
    out, usable = [], [i for i, r in enumerate(rows) if good(r) and r[2] is not None]
    unit = {}
    for i in usable:
        v = np.array(rows[i][1], dtype=np.float32).astype(np.float64)
        unit[i] = v / np.abs(v).max()
        unit[i] /= np.linalg.norm(unit[i])
    left, right, n = [], [], np.zeros(len(rows), dtype=int)
    for i in usable:
        for j in usable:
            same = i != j and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j])
            if same and unit[i] @ unit[j] >= threshold:
                n[i] += 1
                left.append(rows[i][0])
                right.append(rows[j][0])
    nodes, root = smallest_reached(np.array(left, dtype=np.int64), np.array(right, dtype=np.int64))
    low = dict(zip(nodes.tolist(), root.tolist()))
    for i, r in enumerate(rows):
        out.append((r[0], int(n[i]), low.get(r[0], r[0]) if i in unit else r[0], low.get(r[0], r[0]) == r[0] or i not in unit))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_pivot_links_and_components(spark, seed):
    rows = [(i, v.tolist(), i % 2) for i, v in enumerate(clustered(seed, 300))]
    rows += [(1000 + i, rows[i % 5][1], rows[i % 5][2]) for i in range(40)]  # copies
    found = pivot_dedup.near_duplicates(frame(spark, rows)).collect()
    assert sorted(map(tuple, found), key=str) == brute_links(rows)


def test_pivot_tiles_of_a_crowded_list(spark, monkeypatch):
    monkeypatch.setattr(pivot_dedup, "TILE", 16)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(clustered(3, 200, spread=0.02))]
    found = pivot_dedup.near_duplicates(frame(spark, rows)).collect()
    assert sorted(map(tuple, found), key=str) == brute_links(rows)


def test_pivot_recall_with_a_third_near_one_vector(spark):
    rng = np.random.default_rng(5)
    rows = rng.normal(size=(1200, 64))
    rows[:400] = rows[0] + 0.25 * rng.normal(size=(400, 64))
    unit = rows.astype(np.float32).astype(np.float64)
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    want = (unit @ unit.T >= 0.93).sum() - len(rows)
    found = pivot_dedup.near_duplicates(frame(spark, [(i, v.tolist(), 0) for i, v in enumerate(rows)]))
    assert want > 50_000 and found.agg(F.sum("n_links")).first()[0] >= 0.99 * want


def test_pivot_on_odd_rows(spark):
    found = sorted(map(tuple, pivot_dedup.near_duplicates(frame(spark, ODD)).collect()), key=str)
    assert found == brute_links(ODD)
    assert pivot_dedup.near_duplicates(frame(spark, ODD).limit(0)).count() == 0
    assert pivot_dedup.near_duplicates(frame(spark, ODD[1:5])).where("n_links > 0").count() == 0


def brute_nearest(rows, k, every):
    found, seen = [], {(r[0], tuple(r[1])) for r in rows if good(r)}
    for key, q in seen:
        if key % every:
            continue
        a = np.array(q, dtype=np.float32).astype(np.float64)
        scores = [
            (-float((a * np.array(v, dtype=np.float32).astype(np.float64)).sum()), other)
            for other, v in seen if other != key and len(v) == len(q)
        ]
        found += [(key, i + 1, other, -s) for i, (s, other) in enumerate(sorted(scores)[:k])]
    return sorted(found)


@pytest.mark.parametrize("leaf, shard", [(256, 8192), (4, 60)])
def test_exact_search(spark, monkeypatch, leaf, shard):
    monkeypatch.setattr(vptree, "LEAF", leaf)
    monkeypatch.setattr(vptree, "SHARD", shard)
    rows = [(i, (v * (1 + i % 7)).tolist(), 0) for i, v in enumerate(clustered(4, 400))]
    rows += [(1000 + i, rows[7][1], 0) for i in range(50)]  # ties
    rows += [(2000 + i, [float(i % 3), 1.0, 0.0], 0) for i in range(80)]
    found = vptree.search(frame(spark, rows), k=20, every=20).collect()
    have, want = sorted(map(tuple, found)), brute_nearest(rows, 20, 20)
    assert [r[:3] for r in have] == [r[:3] for r in want]
    assert np.allclose([r[3] for r in have], [r[3] for r in want], rtol=1e-12)


@pytest.mark.parametrize("factor, least", [(1.0, 1.0), (2.0, 0.9)])
def test_recall_of_the_table(spark, factor, least):
    vectors = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"], 0) for r in vectors.collect()]
    found = {(r["query_id"], r["vec_id"]) for r in vptree.search(vectors, factor=factor).collect()}
    want = {(r[0], r[2]) for r in brute_nearest(rows, 20, 20)}
    assert len(found & want) >= least * len(want)


def test_search_on_odd_rows(spark):
    rows = [(0, [1.0] * 4, 0), (20, [1.0, 0.0, 0.0, 0.0], 0), *[r for r in ODD if r[0] != 908]]
    have = sorted(map(tuple, vptree.search(frame(spark, rows), k=3, every=20).collect()))
    assert [r[:3] for r in have] == [r[:3] for r in brute_nearest(rows, 3, 20)]
    assert vptree.search(frame(spark, rows).limit(0)).count() == 0


def test_components_of_chains_hubs_and_nothing(spark):
    rng = np.random.default_rng(0)
    chain = [(i, i + 1) for i in range(400)]
    hub = [(5000, int(x)) for x in rng.integers(6000, 9000, 300)]
    loose = [(int(a), int(b)) for a, b in rng.integers(10_000, 10_300, (200, 2))]
    rows = [*chain, *hub, *loose, (None, 3), (7, 7)]
    edges = spark.createDataFrame(rows, "u long, v long").repartition(9)
    left, right = np.array([r for r in rows if None not in r and r[0] != r[1]]).T
    nodes, root = smallest_reached(left, right)
    want = {(a, b) for a, b in zip(nodes.tolist(), root.tolist()) if a != b}
    assert {tuple(r) for r in components(edges).collect()} == want
    assert components(edges.where(F.lit(False))).count() == 0
