"""JSON documents read in ranges give the rows that a whole read gives."""

import json
import random

import pyarrow as pa
import pytest
from pyspark.sql import types as T

from lamina.sources import json_ranges

SCHEMA = "id bigint, s string, n struct<a:array<struct<b:bigint,t:string>>>, f double"


def element(r, i):
    text = "".join(r.choice('ab"\\{}[],: é中\n') for _ in range(r.randint(0, 60)))
    inner = [{"b": r.randint(0, 9), "t": '},{"\\'} for _ in range(r.randint(0, 4))]
    return {"id": i, "s": text, "n": {"a": inner}, "f": r.random()}


def flat(e):
    return e and (e["id"], e["s"], [(x["b"], x["t"]) for x in e["n"]["a"]], e["f"])


@pytest.fixture
def shared(spark, folder):
    spark.sparkContext.setCheckpointDir(f"{folder}/shared")
    return folder


@pytest.mark.parametrize("range_bytes", [700, 5_000, None])
def test_documents_in_ranges(spark, shared, range_bytes):
    r = random.Random(3)
    documents = {
        "plain": [element(r, i) for i in range(1_200)],
        "spread": [element(r, i) for i in range(300)],
        "empty": [],
        "object": element(r, 7),
        "marked": [element(r, 1)],
        "nulls": [element(r, 1), None, element(r, 2)],
        "long": [{**element(r, 1), "s": "x" * 9_000}, {**element(r, 2), "s": "}" * 9_000}],
    }
    for name, doc in documents.items():
        text = json.dumps(doc, ensure_ascii=name == "plain", indent=1 if name in ("spread", "nulls") else None)
        text = {"marked": "﻿" + text, "object": text + "\n" * 2_000}.get(name, text)
        with open(f"{shared}/{name}.json", "w", encoding="utf-8") as out:
            out.write(text)
    with open(f"{shared}/blank.json", "w") as out:
        out.write(" \n")
    found = json_ranges.scan_json_ranges(spark, f"{shared}/*.json", T.StructType.fromDDL(SCHEMA), range_bytes).collect()
    found = {(x["_artifact"].rsplit("/", 1)[1][:-5], x["_position"]): flat(x) if x["n"] else None for x in found}
    want = {}
    for name, doc in documents.items():
        want |= {(name, n): flat(e) for n, e in enumerate(doc if isinstance(doc, list) else [doc])}
    assert found == want


def test_one_file_is_read_by_several_tasks(spark, shared):
    with open(f"{shared}/a.json", "w") as out:
        json.dump([{"id": i} for i in range(5_000)], out)
    usual = spark.conf.get("spark.sql.files.maxPartitionBytes")
    found = json_ranges.scan_json_ranges(spark, f"{shared}/a.json", None, 8_000)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == usual
    assert found.schema.simpleString() == "struct<_artifact:string,_position:int,id:bigint>"
    assert sorted((x["_position"], x["id"]) for x in found.collect()) == [(i, i) for i in range(5_000)]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8000")
    try:
        assert json_ranges._file_rows(spark, f"{shared}/a.json").rdd.getNumPartitions() > 5
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", usual)


@pytest.mark.parametrize("text", ['[{"id": 1}] x', '[{"id": 1}, {"id":]', '[{"id": 1}]}}', '{"id": 1} {"id": 2}', '[{"id": 1}', '{"id": 1', "}"])
def test_broken_documents_are_errors(spark, shared, text):
    with open(f"{shared}/a.json", "w") as out:
        out.write(text)
    with pytest.raises(Exception, match="after the end of the document|MALFORMED|has no end"):
        json_ranges.scan_json_ranges(spark, f"{shared}/a.json", T.StructType.fromDDL("id int")).collect()


def test_keys_of_a_stretch_are_made_once(monkeypatch):
    made = []
    rows = 1_000
    columns = [[b"x"] * rows, ["f"] * 600 + ["g"] * 400, [0] * 300 + [7] * 300 + [0] * 400, [9] * rows]
    kinds = [pa.binary(), pa.string(), pa.int64(), pa.int64()]
    batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["value", "file", "start", "size"])

    class Counted:
        """A batch whose key columns count the values taken out of them as Python objects."""

        num_rows, num_columns = rows, 4

        def column(self, n):
            if n:
                made.append(n)
            return batch.column(n) if n == 0 else Column(batch.column(n))

    class Column:
        def __init__(self, values):
            self.values = values

        def __getitem__(self, at):
            return self.values[at]

        def to_pylist(self):
            raise AssertionError("keys of all rows became Python objects")

    found = list(json_ranges._stretches(iter([Counted()])))
    assert [(key, len(raw)) for key, raw in found] == [(("f", 0, 9), 600), (("f", 7, 9), 600), (("g", 0, 9), 800)]
    assert len(made) < 20
