"""Nested documents to tables."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.functions.names import NameRegistry, identifier, path_fragment
from lamina.operators import relational
from lamina.operators.normalize import normalize
from lamina.sources import files, landing

SF = "/root/testdata/sf0.001"

LINE = "struct<number:int,quantity:double>"
ORDER = f"struct<o_orderkey:bigint,status:string,lines:array<{LINE}>>"
NATION = f"""
    n_nationkey int, labels map<string,string>,
    market struct<
        currency:string,
        buyers:array<struct<c_custkey:bigint,history:array<{ORDER}>>>,
        sellers:array<struct<s_suppkey:bigint,balance:double>>>
"""


def given(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


def nation_documents(spark):
    """A document per nation of the given tables: buyers with their orders and lines, and sellers beside them."""
    lines = F.array_agg(F.struct(F.col("l_linenumber").alias("number"), F.col("l_quantity").alias("quantity"))).alias("lines")
    orders = given(spark, "orders").join(given(spark, "lineitem").groupBy("l_orderkey").agg(lines), F.expr("o_orderkey = l_orderkey"), "left")
    history = F.array_agg(F.struct("o_orderkey", F.col("o_orderstatus").alias("status"), "lines")).alias("history")
    customers = given(spark, "customer").join(orders.groupBy("o_custkey").agg(history), F.expr("c_custkey = o_custkey"), "left")
    buyers = customers.groupBy("c_nationkey").agg(F.array_agg(F.struct("c_custkey", "history")).alias("buyers"))
    sellers = given(spark, "supplier").groupBy("s_nationkey").agg(
        F.array_agg(F.struct("s_suppkey", F.col("s_acctbal").alias("balance"))).alias("sellers")
    )
    found = given(spark, "nation").join(given(spark, "region"), F.expr("n_regionkey = r_regionkey"))
    found = found.join(buyers, F.expr("n_nationkey = c_nationkey"), "left").join(sellers, F.expr("n_nationkey = s_nationkey"), "left")
    labels = F.create_map(F.lit("nation"), "n_name", F.lit("region"), "r_name")
    market = F.struct(F.lower(F.left("n_name", F.lit(3))).alias("currency"), "buyers", "sellers")
    return found.select("n_nationkey", labels.alias("labels"), market.alias("market"))


@pytest.fixture
def nations_file(spark, folder):
    with open(f"{folder}/nations.json", "w", encoding="utf-8") as handle:
        handle.write("[" + ",\n".join(nation_documents(spark).toJSON().collect()) + "]")
    return f"{folder}/nations.json"


@pytest.fixture
def nations(spark, nations_file):
    docs = files.scan_documents(spark, nations_file, T.StructType.fromDDL(NATION))
    key = relational.document_key(F.col(files.ARTIFACT), F.col(files.POSITION))
    return relational.relationalize(docs, "nation", key)


def test_every_array_is_a_table_with_all_its_elements(spark, nations):
    given_as = {
        "nation": "nation", "nation__market__buyers": "customer", "nation__market__sellers": "supplier",
        "nation__history": "orders", "nation__lines": "lineitem",
    }
    assert {name: df.count() for name, df in nations.items()} == {n: given(spark, t).count() for n, t in given_as.items()}


def test_structs_are_flattened_and_maps_stay(spark, nations):
    found = {r["n_nationkey"]: (r["market__currency"], r["labels"]) for r in nations["nation"].collect()}
    named = given(spark, "nation").join(given(spark, "region"), F.expr("n_regionkey = r_regionkey")).collect()
    want = {r.n_nationkey: (r.n_name[:3].lower(), {"nation": r.n_name, "region": r.r_name}) for r in named}
    assert found == want


def test_rows_lead_up_to_their_documents(spark, nations):
    """Quantities summed from the lowest table by the root's key are those of the given tables."""
    joined, above = nations["nation__lines"].alias("lines"), "lines"
    for name in ("nation__history", "nation__market__buyers", "nation"):
        joined = joined.join(nations[name].alias(name), F.col(f"{above}._parent_row_id") == F.col(f"{name}._row_id"))
        above = name
    found = joined.groupBy("n_nationkey").agg(F.sum("quantity").alias("q"), F.count_distinct("o_orderkey").alias("n"))
    lines = given(spark, "lineitem").join(given(spark, "orders"), F.expr("l_orderkey = o_orderkey"))
    want = lines.join(given(spark, "customer"), F.expr("o_custkey = c_custkey")).groupBy("c_nationkey").agg(
        F.sum("l_quantity").alias("q"), F.count_distinct("o_orderkey").alias("n")
    )
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect()))


def test_arrays_side_by_side_have_the_same_parents(spark, nations):
    sellers = nations["nation__market__sellers"].alias("s")
    found = sellers.join(nations["nation"].alias("n"), F.expr("s._parent_row_id = n._row_id")).select("s_suppkey", "n_nationkey")
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, given(spark, "supplier").select("s_suppkey", "s_nationkey").collect()))


def test_keys_tell_nulls_and_separators_apart(spark):
    rows = [("a", None, "b"), ("a", "b", None), ("a|b", "c", "x"), ("a", "b|c", "x"), ("", None, "b"), (None, "", "b")]
    df = spark.createDataFrame(rows, "x string, y string, z string")
    keys = df.select(relational.document_key(F.col("x"), F.col("y"), F.col("z")).alias("k")).collect()
    assert len({r["k"] for r in keys}) == len(rows)


def test_replay_gives_the_same_keys(spark, nations_file, nations):
    first = {n: sorted(r["_row_id"] for r in df.select("_row_id").collect()) for n, df in nations.items()}
    assert all(len(ids) == len(set(ids)) for ids in first.values())
    docs = files.scan_documents(spark, nations_file, T.StructType.fromDDL(NATION)).repartition(3)
    key = relational.document_key(F.col(files.ARTIFACT), F.col(files.POSITION))
    again = relational.relationalize(docs, "nation", key)
    assert first == {n: sorted(r["_row_id"] for r in df.select("_row_id").collect()) for n, df in again.items()}


def test_array_under_struct_and_field_called_value(spark):
    schema = "id int, box struct<lists:array<struct<value:string,`odd name`:array<int>>>>"
    df = spark.createDataFrame([(1, ([("v", [1, 2]), (None, None), None],))], schema)
    tables = relational.relationalize(df, "thing", relational.document_key(F.col("id")))
    assert sorted(tables) == ["thing", "thing__box__lists", "thing__odd_name"]
    lists = [(r["_array_index"], r["value"]) for r in tables["thing__box__lists"].collect()]
    assert sorted(lists, key=lambda x: x[0]) == [(0, "v"), (1, None), (2, None)]
    assert sorted(r["value"] for r in tables["thing__odd_name"].collect()) == [1, 2]


def test_maps_and_inner_arrays_stay(spark):
    schema = "id int, m map<string,int>, a array<array<int>>"
    df = spark.createDataFrame([(1, {"x": 1}, [[1, 2], [3]])], schema)
    tables = relational.relationalize(df, "t", relational.document_key(F.col("id")))
    assert tables["t"].first()["m"] == {"x": 1}
    assert sorted(r["value"] for r in tables["t__a"].collect()) == [[1, 2], [3]]


def test_clashing_names_get_a_hash():
    item = T.ArrayType(T.StructType([T.StructField("sku", T.StringType())]))
    schema = T.StructType([T.StructField("line-items", item), T.StructField("line_items", item),
                           T.StructField("A b", T.StringType()), T.StructField("a_b", T.StringType())])
    specs = relational.plan_tables("orders", schema)
    names = [s.name for s in specs]
    assert names[1] == "orders__line_items"
    assert names[2].startswith("orders__line_items__") and len(names[2]) == len(names[1]) + 10
    columns = [name for _, _, name in specs[0].columns]
    assert columns[0] == "a_b" and columns[1].startswith("a_b__") and len(set(columns)) == 2


def test_long_names_are_cut():
    registry = NameRegistry(30)
    name = registry.claim(["entity", "a" * 40], "$.x")
    assert len(name) <= 30
    assert registry.claim(["entity", "a" * 40], "$.x") == name
    with pytest.raises(ValueError):
        NameRegistry(8).claim(["a" * 20], "$.y")


def test_identifier_rules():
    assert identifier("  Line-Items (new) ") == "line_items_new"
    assert identifier("---") == "value"
    assert path_fragment("a b/c") == "a_b_c"
    assert path_fragment("") == "unknown"


def test_mapping_version_follows_structure(spark):
    one = relational.plan_tables("e", spark.range(1).schema)
    same = relational.plan_tables("e", spark.range(5).schema)
    other = relational.plan_tables("e", spark.range(1).withColumn("x", F.lit(1)).schema)
    assert relational.mapping_version(one) == relational.mapping_version(same)
    assert relational.mapping_version(one) != relational.mapping_version(other)
    catalog = relational.mapping_catalog(spark, "s", "e", other)
    assert sorted(r["column_name"] for r in catalog.collect()) == ["id", "x"]


def test_partition_values():
    manifest = {"ingest_date": "2024-01-02", "metadata": {"business_date": "2024-01-01"}}
    assert relational.partition_values("none", manifest) == {}
    assert relational.partition_values("ingest_date", manifest) == {"ingest_date": "2024-01-02"}
    assert relational.partition_values("business_date", manifest) == {"business_date": "2024-01-01"}
    with pytest.raises(ValueError):
        relational.partition_values("business_date", {"metadata": {}})
    with pytest.raises(ValueError):
        relational.partition_values("source_key", manifest)
    by_key = relational.partition_values("source_key", {"metadata": {"region": "eu"}}, None, "region")
    assert by_key == {"source_key": "eu"}


def test_array_root_with_byte_order_mark(spark, folder):
    with open(f"{folder}/a.json", "w", encoding="utf-8-sig") as handle:
        json.dump([{"a": 1}, {"a": 2}], handle)
    rows = files.scan_documents(spark, f"{folder}/a.json", T.StructType([
        T.StructField("a", T.LongType())]))
    assert sorted((r[files.POSITION], r["a"]) for r in rows.collect()) == [(0, 1), (1, 2)]


def test_csv_is_text(spark, folder):
    with open(f"{folder}/a.csv", "w", encoding="utf-8-sig", newline="") as handle:
        handle.write('order_id,amount,note\n001,1.50,"a ""b"", c"\n002,,\n')
    df = files.scan_csv(spark, f"{folder}/a.csv", escape='"')
    assert df.columns == ["order_id", "amount", "note"]
    assert sorted(tuple(r) for r in df.collect()) == [("001", "1.50", 'a "b", c'), ("002", None, None)]


def test_csv_bad_bytes_are_found(spark, folder):
    with open(f"{folder}/bad.csv", "wb") as handle:
        handle.write(b"a,b\n1,ok\n2,\xff\xfe\n")
    assert files.undecodable_rows(files.scan_csv(spark, f"{folder}/bad.csv")).count() == 1


def test_level2_runs_accumulate_and_refuse_overwrite(spark, folder):
    def put(run, day, df):
        return landing.write_level2(
            relational.with_lineage(df, "shop", day, run), folder, source="shop", entity="orders",
            table="orders", mapping_version="v1", run_id=run, partition={"ingest_date": day},
        )

    assert put("001", "2024-01-01", spark.range(2))["rows_written"] == 2
    put("002", "2024-01-02", spark.range(3).withColumn("extra", F.lit("x")))
    df = landing.read_level2(spark, folder, "shop", "orders", "orders")
    assert df.count() == 5
    assert {r["run_id"] for r in df.collect()} == {"001", "002"}
    assert dict(df.dtypes)["ingest_date"] == "string"
    assert df.filter("extra IS NULL").count() == 2
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        put("001", "2024-01-01", spark.range(2))
    with pytest.raises(FileNotFoundError):
        landing.read_level2(spark, folder, "shop", "orders", "nothing")


def test_broken_document_is_an_error(spark, folder):
    with open(f"{folder}/a.json", "w", encoding="utf-8") as handle:
        handle.write('{"a": 1')
    schema = T.StructType([T.StructField("a", T.LongType())])
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        files.scan_documents(spark, f"{folder}/a.json", schema).collect()


def test_normalize_writes_every_table_once(spark, folder, nations_file, nations):
    docs = files.scan_documents(spark, nations_file, T.StructType.fromDDL(NATION))
    identity = [files.ARTIFACT, files.POSITION]
    key = relational.document_key(*[F.col(c) for c in identity])
    catalog, manifests = normalize(
        docs, f"{folder}/out", source="world", entity="nation", row_id=key, run_id="r1",
        ingest_date="2024-01-02", partition={"ingest_date": "2024-01-02"}, identity_columns=identity,
    )
    assert {m["table_name"]: m["rows_written"] for m in manifests} == {n: df.count() for n, df in nations.items()}
    roots = landing.read_level2(spark, f"{folder}/out", "world", "nation", "nation").collect()
    assert {(r["source_name"], r["_run_id"]) for r in roots} == {("world", "r1")}
    assert {r["_row_id"] for r in roots} == {r["_row_id"] for r in nations["nation"].collect()}
    assert files.ARTIFACT not in roots[0].asDict()
    assert sorted(r["column_name"] for r in catalog.where("table_name = 'nation'").collect()) == [
        "labels", "market__currency", "n_nationkey",
    ]
