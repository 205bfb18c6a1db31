"""Quality checks, quarantine and contracts."""

import json
from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from lamina.operators import contracts, quality
from lamina.operators.contracts import ColumnContract
from lamina.operators.quality import Check

NOW = datetime(2026, 8, 25, 12)


def result(df, check, references=None):
    return quality.evaluate(df, [check], references, NOW, "d").first()


def test_not_null(spark):
    df = spark.createDataFrame([(1, "a@x"), (2, None), (None, "b@x")], "id int, email string")
    row = result(df, Check("c", "not_null", column="email"))
    assert (row["status"], row["observed"]) == ("fail", 1.0)
    assert row["message"] == "1 of 3 rows violate"
    assert result(df, Check("c", "not_null", column="missing"))["observed"] == 3.0


def test_unique_counts_all_rows_of_a_group(spark):
    df = spark.createDataFrame(
        [(1, 1), (1, 1), (1, 2), (None, None), (None, 3), (None, 3)], "a int, b int"
    )
    check = Check("u", "uniqueness", columns=("a", "b"))
    assert result(df, check)["observed"] == 5.0
    bad = quality.violations(df, check).collect()
    assert sorted(map(str, bad)) == sorted(
        map(str, [r for r in df.collect() if tuple(r) != (1, 2)])
    )


@pytest.mark.parametrize("value,bad", [
    ("5", False), ("1e1", False), (" 7 ", False), ("", False), (None, False), ("11", True),
    ("abc", True), ("5d", True), ("nan", True), ("-1", True), ("10.0", False), ("0x5", True),
])
def test_range_on_text(spark, value, bad):
    df = spark.createDataFrame([(value,)], "v string")
    check = Check("r", "range", column="v", min_value=0, max_value=10)
    assert quality.violations(df, check).count() == int(bad)


def test_range_bounds_and_nan(spark):
    df = spark.createDataFrame([(0.0,), (10.0,), (float("nan"),), (None,)], "v double")
    open_ends = Check("r", "range", column="v", min_value=0, max_value=10,
                      inclusive_lower=False, inclusive_upper=False)
    assert result(df, open_ends)["observed"] == 2.0
    assert result(df, Check("r", "range", column="v"))["status"] == "skipped"
    with pytest.raises(ValueError):
        Check("r", "range", column="v", min_value=2, max_value=1)


def test_foreign_key(spark):
    orders = spark.createDataFrame([(1, 1), (2, 2), (3, 9), (4, None)], "id int, user_id int")
    users = spark.createDataFrame([(1,), (2,), (2,)], "id int")
    check = Check("fk", "referential_integrity", column="user_id",
                  target_dataset_id="app.users", target_column="id")
    row = result(orders, check, {"users": users})
    assert (row["status"], row["observed"]) == ("fail", 1.0)
    assert quality.violations(orders, check, {"users": users}).first()["id"] == 3
    assert result(orders, check)["status"] == "skipped"
    assert result(orders, check, {"users": users.limit(0)})["observed"] == 3.0


def test_freshness(spark):
    df = spark.createDataFrame(
        [("2026-08-25T11:00:00Z",), ("2026-08-10",), ("2026-08-25T13:00:00+02:00",),
         ("later",), (None,)], "at string",
    )
    row = result(df, Check("f", "freshness", column="at", max_age_seconds=7 * 86400))
    assert row["status"] == "fail"
    assert row["observed"] == 15.5 * 86400
    assert row["message"] == "2 of 5 rows violate"


def test_regex_is_unanchored(spark):
    df = spark.createDataFrame([("xx-12",), ("12",), (None,), ("ab",)], "v string")
    assert result(df, Check("x", "regex_format", column="v", pattern=r"\d+"))["observed"] == 1.0
    numbers = spark.createDataFrame([(1,)], "v int")
    assert result(numbers, Check("x", "regex_format", column="v", pattern="1"))["observed"] == 1.0


def test_row_local_checks_share_one_scan(spark, folder):
    spark.range(10).write.parquet(f"{folder}/t")
    df = spark.read.parquet(f"{folder}/t")
    checks = [Check("a", "not_null", column="id"), Check("b", "range", column="id", min_value=3),
              Check("c", "row_count_min", row_count_min=20)]
    out = quality.evaluate(df, checks)
    assert out._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert [(r["status"], r["observed"]) for r in out.collect()] == [
        ("pass", 0.0), ("fail", 3.0), ("fail", 10.0)
    ]


def test_split_and_quarantine(spark, folder):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "b")], "id int, v string")
    checks = [Check("n", "not_null", column="v"), Check("u", "uniqueness", columns=("id",))]
    clean, bad = quality.split_clean(df, checks)
    assert [r["id"] for r in clean.collect()] == [2]
    records = quality.quarantine_records(
        bad, run_id="r", stage="level2", dataset="d", environment="e", captured_at="t"
    )
    quality.write_quarantine(records, f"{folder}/q")
    stored = spark.read.json(f"{folder}/q").collect()
    assert sorted(r["check_name"] for r in stored) == ["n", "u", "u"]
    assert json.loads(next(r["record"] for r in stored if r["check_name"] == "n")) == {"id": 1, "v": None}


def test_blocking_policy_raises(spark):
    df = spark.createDataFrame([(None,)], "v int")
    results = quality.evaluate(df, [Check("n", "not_null", column="v")])
    assert quality.enforce(results)[0]["status"] == "fail"
    with pytest.raises(quality.QualityFailure, match="n: 1 of 1"):
        quality.enforce(results, "blocking")


def test_suite_documents():
    item = {"check_name": "x", "kind": "not_null", "column": "a"}
    for text in (json.dumps([item]), json.dumps({"checks": [item]}),
                 "quality_checks:\n- {check_name: x, kind: not_null, column: a}\n"):
        assert quality.load_suite(text) == [Check("x", "not_null", column="a")]
    fk = {"check_name": "x", "kind": "referential_integrity", "source_column": "a",
          "target_dataset_id": "t", "target_column": "b", "dataset_id": "d"}
    check = quality.load_suite(json.dumps([fk]))[0]
    assert check.column == "a"
    assert quality.applies_to(check, "d", "name") and not quality.applies_to(check, "other")
    for broken in ({"kind": "nothing", "check_name": "x"}, {"kind": "range", "check_name": "x"}):
        with pytest.raises(ValueError):
            quality.load_suite(json.dumps([broken]))
    with pytest.raises(ValueError):
        quality.load_suite('"text"')


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from([None, 1, 2, 3]), st.sampled_from([None, "a", "b"])),
                min_size=1, max_size=12))
def test_uniqueness_against_brute_force(spark, data):
    df = spark.createDataFrame(data, "a int, b string")
    want = sum(1 for r in data if data.count(r) > 1 or r == (None, None))
    check = Check("u", "uniqueness", columns=("a", "b"))
    assert result(df, check)["observed"] == want
    assert quality.violations(df, check).count() == want


def test_missing_key_columns_count_as_null(spark):
    df = spark.range(3)
    unique = Check("u", "uniqueness", columns=("nope",))
    assert result(df, unique)["observed"] == 3.0
    flagged = quality.violations(df, unique)
    assert flagged.columns == ["id"] and flagged.count() == 3
    fk = Check("f", "referential_integrity", column="nope", target_dataset_id="t", target_column="id")
    assert result(df, fk, {"t": df.withColumn("id", df["id"].cast("string"))})["status"] == "pass"


def test_row_contract_modes(spark):
    df = spark.createDataFrame([("1",), ("x",)], "a string")
    declared = [ColumnContract("a", "int")]
    assert contracts.enforce_rows(df, declared) == (df, None)
    clean, bad = contracts.enforce_rows(df, declared, "warn")
    assert (clean.count(), bad.count()) == (1, 1)
    with pytest.raises(contracts.ContractViolation):
        contracts.enforce_rows(df, declared, "strict")
    assert contracts.enforce_rows(df.limit(1), declared, "strict")[0].count() == 1


def test_contract_diff_buckets():
    schema = T._parse_datatype_string("a int, b string, d array<map<string, struct<x:decimal(18,4)>>>")
    declared = [ColumnContract("a", " bigint "), ColumnContract("b", "STRING", False),
                ColumnContract("c"), ColumnContract("d", "Array<Map<String,Struct<x:Decimal(18, 4)>>>")]
    found = contracts.diff(declared, schema)
    assert (found.added, found.removed) == ((), ("c",))
    assert [c["column"] for c in found.changed] == ["a", "b"]
    assert found.changed[0]["expected_type"] == "BIGINT"
    assert not contracts.diff([ColumnContract("a", "integer")], T._parse_datatype_string("a int"))


def test_contract_modes():
    schema = T._parse_datatype_string("a int")
    declared = [ColumnContract("a", "string")]
    assert contracts.enforce(declared, schema, mode="off") == []
    assert len(contracts.enforce(declared, schema, schema, "warn")) == 2
    with pytest.raises(contracts.ContractViolation):
        contracts.enforce(declared, schema, mode="strict")
    nullable = [ColumnContract("a", "int", False)]
    where = [w for w, _ in contracts.enforce(nullable, schema, schema, "warn")]
    assert where == ["dataframe_schema"]


def test_conform_casts_clean_rows(spark):
    df = spark.createDataFrame([("1", "x"), ("q", "y"), ("3", None)], "a string, b string")
    declared = [ColumnContract("a", "int"), ColumnContract("b", "string", False)]
    clean, bad = contracts.conform(df, declared)
    assert [tuple(r) for r in clean.collect()] == [(1, "x")]
    assert sorted(r["_violations"] for r in bad.collect()) == [["a:type"], ["b:null"]]
    counts = {r["column_name"]: tuple(r)[1:] for r in contracts.conformance(df, declared).collect()}
    assert counts == {"a": (1, 0), "b": (0, 1)}


def test_an_absent_required_column_is_null_in_every_row(spark):
    df = spark.createDataFrame([(1,), (2,)], "a int")
    declared = [ColumnContract("a", "int"), ColumnContract("b", "string", nullable=False)]
    with pytest.raises(contracts.ContractViolation):
        contracts.enforce_rows(df, declared, "strict")
    counts = {r["column_name"]: r["null_violations"] for r in contracts.conformance(df, declared).collect()}
    assert counts == {"a": 0, "b": 2}


def test_no_checks_give_no_results(spark):
    assert quality.evaluate(spark.range(3), []).count() == 0
