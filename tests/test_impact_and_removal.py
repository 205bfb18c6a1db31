"""Impact of many starts at once, and removal of files in batches."""

import os
import random
from collections import defaultdict, deque

import pytest
from pyspark.sql import functions as F

from lamina.operators import lineage, maintenance, skew


@pytest.fixture(autouse=True)
def shared(spark, folder):
    spark.sparkContext.setCheckpointDir(f"{folder}/shared")


def plain_impact(edges, starts, depth):
    after = defaultdict(set)
    for a, b in edges:
        after[a].add(b)
    found = set()
    for start in starts:
        steps, waiting = {start: 0}, deque([start])
        while waiting:
            node = waiting.popleft()
            for other in after[node] if steps[node] < depth else ():
                if other not in steps:
                    steps[other] = steps[node] + 1
                    waiting.append(other)
        found |= {(start, node, n) for node, n in steps.items() if n}
    return found


@pytest.mark.parametrize("direction", ["downstream", "upstream"])
def test_least_depths_of_many_starts(spark, direction, monkeypatch):
    r = random.Random(11)
    nodes = [f"n{i}" for i in range(60)]
    edges = [(r.choice(nodes), r.choice(nodes)) for _ in range(90)] + [("n0", n) for n in nodes] + [("n1", "n0"), ("n0", "n1")]
    df = spark.createDataFrame(edges + edges[:9], "source string, target string")
    starts = [*nodes[:40], "elsewhere"]
    listed = spark.createDataFrame([(s,) for s in [*starts, "n3", None]], "x string")
    walked = edges if direction == "downstream" else [(b, a) for a, b in edges]
    want = plain_impact(walked, starts, 3)
    for hot_rows in (skew.HOT_ROWS, 5):  # the hub is split in the second turn
        monkeypatch.setattr(skew, "HOT_ROWS", hot_rows)
        found = lineage.impact_of_many(df, listed, direction, 3)
        assert found.columns == ["start", "node", "depth"]
        rows = list(map(tuple, found.collect()))
        assert len(rows) == len(set(rows)) and set(rows) == want
    one = lineage.impact(df, "n5", direction, 3)
    assert {("n5", *r) for r in one.collect()} == {r for r in want if r[0] == "n5"}
    assert lineage.impact_of_many(df, listed.limit(0), direction).collect() == []


def test_files_go_in_batches_and_once(spark, folder, monkeypatch):
    monkeypatch.setattr(maintenance, "HELD", 7)
    os.makedirs(f"{folder}/t")
    for i in range(40):
        open(f"{folder}/t/f{i}", "w").close()
    listed = spark.createDataFrame([(f"{folder}/t/f{i % 30}",) for i in range(60)] + [(None,)], "path string")
    assert maintenance.remove_files(spark, listed) == 30
    assert sorted(os.listdir(f"{folder}/t")) == sorted(f"f{i}" for i in range(30, 40))
    assert maintenance.remove_files(spark, listed) == 30


def test_events_are_compressed_and_no_file_is_large(spark, folder, monkeypatch):
    monkeypatch.setattr(lineage, "FILE_EVENTS", 300)
    names = F.concat(F.lit("order:"), "id")
    facet = 'struct("lamina" AS namespace, concat("customer:", id) AS name, "id" AS field)'
    events = spark.range(0, 2000, 1, 2).select(
        F.lit("COMPLETE").alias("event_type"), F.lit("2024-01-01T00:00:00Z").alias("event_time"),
        F.md5(names).alias("run_id"), F.lit("job").alias("job_name"),
        F.expr('array(struct("lamina" AS namespace, concat("customer:", id) AS name))').alias("inputs"),
        F.expr(
            'array(struct("lamina" AS namespace, concat("order:", id) AS name, struct(struct('
            f'map("key", struct(array({facet}) AS inputFields)) AS fields) AS columnLineage) AS facets))'
        ).alias("outputs"),
    )
    events.write.json(f"{folder}/plain")
    lineage.write_events(events, f"{folder}/events")

    def size(path):
        return sum(os.path.getsize(os.path.join(path, f)) for f in os.listdir(path) if f.startswith("part-"))

    written = [f for f in os.listdir(f"{folder}/events") if f.startswith("part-")]
    assert len(written) == 8 and size(f"{folder}/events") < size(f"{folder}/plain") / 4
    found = lineage.column_edges(lineage.read_events(spark, f"{folder}/events"))
    assert {tuple(r) for r in found.collect()} == {
        (f"customer:{n}", "id", f"order:{n}", "key") for n in range(2000)
    }
