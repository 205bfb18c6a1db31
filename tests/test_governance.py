"""Masks, policies, retention and erasure."""

import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from lamina.functions.masks import STRATEGIES, mask
from lamina.operators import governance, loads, skew
from lamina.operators.governance import ColumnPolicy


@pytest.mark.parametrize("strategy,tier,value,expected", [
    ("none", None, "abc", "abc"),
    ("nullify", None, "abc", None),
    ("hash_sha256", None, "abc", "ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad"),
    ("redact_email", None, "user@example.com", "u**r@example.com"),
    ("redact_email", None, "ab@x.org", "**@x.org"),
    ("redact_email", None, "nobody", "******"),
    ("redact_ssn", None, "123-45-6789", "***-**-6789"),
    ("truncate_middle", None, "abcd", "****"),
    ("truncate_middle", None, "abcdef", "a****f"),
    ("truncate_end", "confidential", "abcdefgh", "abcd****"),
    ("truncate_end", "internal", "abcdefghi", "abcdefgh**"),
    ("truncate_end", "internal", "abcdefgh", "********"),
])
def test_masks(spark, strategy, tier, value, expected):
    df = spark.createDataFrame([(value,), (None,)], "v string")
    out = [r[0] for r in df.select(mask(F.col("v"), strategy, tier)).collect()]
    assert out == [expected, None]


def test_unknown_mask():
    with pytest.raises(ValueError):
        mask(F.lit("x"), "blur")
    assert len(STRATEGIES) == 7


def test_policy_rules():
    with pytest.raises(ValueError):
        ColumnPolicy("a", None, "nullify")
    with pytest.raises(ValueError):
        ColumnPolicy("a", "public", "nullify")
    with pytest.raises(ValueError):
        ColumnPolicy("a", "secret")
    assert governance.effective(ColumnPolicy("a", "restricted_pii")) == ("restricted_pii", "nullify")
    assert governance.effective(ColumnPolicy("a"), "confidential") == ("confidential", "truncate_end")
    assert governance.effective(ColumnPolicy("a", "public"), "confidential") == ("public", "none")
    assert governance.strictest("internal", [ColumnPolicy("a", "confidential")]) == "confidential"
    assert governance.strictest(None, []) is None


def test_masked_view_by_role(spark):
    df = spark.createDataFrame([(1, "user@example.com")], "id int, email string")
    policies = [ColumnPolicy("email", "restricted_pii", "redact_email")]
    hidden = governance.masked_view(df, policies, None, "officer")
    assert hidden.first()["email"] == "u**r@example.com"
    shown = governance.masked_view(df, policies, None, "officer", ["officer"])
    assert shown.first()["email"] == "user@example.com"


def test_table_properties(spark):
    props = governance.table_properties([ColumnPolicy("id", "confidential")], "internal", 30, "o'b")
    assert props["governance.classification"] == "confidential"
    spark.sql("CREATE TABLE governed (id INT) USING parquet")
    try:
        governance.set_table_properties(spark, "governed", props)
        stored = {r["key"]: r["value"] for r in spark.sql("SHOW TBLPROPERTIES governed").collect()}
        assert stored["governance.owner"] == "o'b"
        assert stored["governance.retention_days"] == "30"
    finally:
        spark.sql("DROP TABLE governed")


def test_retention(spark):
    df = spark.createDataFrame([(date(2024, 1, 1),), (date(2024, 1, 10),), (None,)], "d date")
    kept = governance.retain(df, "d", 5, date(2024, 1, 10))
    assert sorted(str(r["d"]) for r in kept.collect()) == ["2024-01-10", "None"]
    with pytest.raises(ValueError):
        governance.retain(df, "d", 0, date(2024, 1, 1))


def test_erasure(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (None, "c")], "id int, v string")
    assert governance.erase_where(df, {"v": None}).count() == 2
    with pytest.raises(ValueError):
        governance.erase_where(df, {})
    ids = spark.createDataFrame([(1,), (1,), (None,)], "x int")
    left = governance.erase_ids(df, "id", ids)
    assert sorted(str(r["id"]) for r in left.collect()) == ["2", "None"]


def test_erasure_reaches_children(spark):
    parent = spark.createDataFrame([("p1", 1), ("p2", 2)], "_row_id string, person int")
    child = spark.createDataFrame([("p1", "x"), ("p2", "y"), ("p1", "z")], "_parent_row_id string, v string")
    ids = spark.createDataFrame([(1,)], "person int")
    left = governance.erase_cascade(parent, {"c": (child, "_parent_row_id")}, "person", ids, "_row_id")
    assert [r["_row_id"] for r in left["parent"].collect()] == ["p2"]
    assert [r["v"] for r in left["c"].collect()] == ["y"]


def test_retention_and_erasure_of_a_stored_table(spark, folder):
    path, parts = f"{folder}/t", ["day"]
    rows = spark.range(20).selectExpr("id", "date_add(DATE '2024-01-01', CAST(id % 5 AS INT)) AS day", "true AS ok")
    loads.load(rows, path, "partition_overwrite", parts)
    kept_files = {f for d, _, fs in os.walk(path) for f in fs if d.endswith("day=2024-01-05")}
    assert governance.apply_retention(spark, path, rows.schema, "day", 2, date(2024, 1, 4), parts) == 4
    assert not os.path.exists(f"{path}/day=2024-01-01")
    ids = spark.createDataFrame([(1,), (2,), (99,)], "id long")
    assert governance.apply_erasure(spark, path, rows.schema, "id", ids, parts) == 2
    stored = loads.read_table(spark, path, rows.schema)
    assert sorted(r["id"] for r in stored.collect()) == [i for i in range(20) if i % 5 and i not in (1, 2)]
    assert kept_files == {f for d, _, fs in os.walk(path) for f in fs if d.endswith("day=2024-01-05")}
    assert governance.apply_erasure(spark, path, rows.schema, "id", ids, parts) == 0


def test_erasure_reaches_grandchildren(spark):
    tables = {
        "a": spark.createDataFrame([(1, "x"), (2, "y")], "person int, a string"),
        "b": spark.createDataFrame([("x", "p"), ("x", "q"), ("y", "r")], "up string, b string"),
        "c": spark.createDataFrame([("p", 1), ("q", 2), ("r", 3)], "up string, n int"),
    }
    ids = spark.createDataFrame([(1,)], "person int")
    left = governance.erase_tree(tables, [("b", "up", "a", "a"), ("c", "up", "b", "b")], "a", "person", ids)
    assert [r["n"] for r in left["c"].collect()] == [3]
    with pytest.raises(ValueError):
        governance.erase_tree(tables, [("c", "up", "b", "b")], "a", "person", ids)


def noted(spark, folder, name="t", parts=("day",)):
    rows = spark.range(30).selectExpr(
        "id", "if(id % 6 = 0, null, id % 4) AS person", "map('a', id, 'b', null) AS m",
        "array(named_struct('x', map(id, 'y'))) AS deep", "if(id % 5 = 4, null, id % 5) AS day",
    )
    loads.load(rows, f"{folder}/{name}", "partition_overwrite" if parts else "full_refresh", list(parts))
    return rows, f"{folder}/{name}"


def test_deletion_from_tables_with_maps(spark, folder, monkeypatch):
    rows, path = noted(spark, folder)
    assert governance.delete_where(spark, path, rows.schema, F.col("m")["a"] > 24, ["day"]) == 5
    assert governance.apply_erasure_where(spark, path, rows.schema, {"day": None}, ["day"]) == 5
    # hot ids are salted by a hash of the row, which leaves maps out
    monkeypatch.setattr(skew, "HOT_ROWS", 2)
    ids = spark.createDataFrame([(1,), (1,), (None,)], "x long")
    before = loads.read_table(spark, path, rows.schema).count()
    gone = governance.apply_erasure(spark, path, rows.schema, "person", ids, ["day"])
    left = loads.read_table(spark, path, rows.schema).collect()
    assert gone == before - len(left) > 0
    want = {i for i in range(25) if i % 5 != 4 and (i % 6 == 0 or i % 4 != 1)}
    assert {r.id for r in left} == want and all(r.m == {"a": r.id, "b": None} for r in left)
    assert governance.delete_where(spark, path, rows.schema, F.lit(None).cast("boolean"), ["day"]) == 0


def test_deletion_of_everything(spark, folder):
    rows, path = noted(spark, folder, parts=())
    assert governance.delete_where(spark, path, rows.schema, F.col("id") >= 0) == 30
    assert loads.read_table(spark, path, rows.schema).count() == 0


def test_stored_cascade_reaches_grandchildren_over_two_ways(spark, folder):
    def stored(name, rows, schema, parts=()):
        df = spark.createDataFrame(rows, schema)
        loads.load(df, f"{folder}/{name}", "partition_overwrite" if parts else "full_refresh", parts)
        return governance.StoredTable(f"{folder}/{name}", df.schema, tuple(parts))

    tables = {
        "a": stored("a", [(1, "x"), (2, "y"), (3, None)], "person int, a string"),
        "b": stored("b", [("x", "p", 1), ("x", "q", 2), ("y", "r", 1), (None, "s", 1)], "up string, b string, d int", ["d"]),
        "c": stored("c", [("p", 1, "y"), ("q", 2, "y"), ("r", 3, "y"), ("r", 4, "x"), (None, 5, None)], "up string, n int, a string"),
    }
    links = [("b", "up", "a", "a"), ("c", "up", "b", "b"), ("c", "a", "a", "a")]
    ids = spark.createDataFrame([(1,), (3,), (9,)], "person int")
    assert governance.erase_stored_tree(spark, tables, links, "a", "person", ids) == {"a": 2, "b": 2, "c": 3}
    left = {n: loads.read_table(spark, t.path, t.schema).collect() for n, t in tables.items()}
    assert [r.person for r in left["a"]] == [2]
    assert sorted(r.b for r in left["b"]) == ["r", "s"]
    assert sorted(r.n for r in left["c"]) == [3, 5]
    assert governance.erase_stored_tree(spark, tables, links, "a", "person", ids) == {"a": 0, "b": 0, "c": 0}
    with pytest.raises(ValueError, match="before its parent"):
        governance.erase_stored_tree(spark, tables, links[1:], "a", "person", ids)
