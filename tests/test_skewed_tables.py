"""Queries on tables in which one key holds a third of the rows, with the salted paths on."""

import __spark_entry__ as entry_point
import compare
import duckdb
import pytest

from lamina.operators import skew

SOURCE = "/root/testdata/sf0.001"
# one hot customer, order, event type and user; a third of the documents are copies
SKEWED = {
    "orders": """SELECT * REPLACE (
        CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_custkey END AS o_custkey,
        CASE WHEN o_orderkey % 3 = 1 THEN TIMESTAMP '1998-05-05' ELSE o_orderdate END AS o_orderdate)""",
    "lineitem": """SELECT * REPLACE (
        CASE WHEN (l_partkey + l_linenumber) % 3 = 0 THEN 11 ELSE l_orderkey END AS l_orderkey)""",
    "events": """SELECT * REPLACE (
        CASE WHEN event_id % 3 = 0 THEN 'view' ELSE event_type END AS event_type,
        CASE WHEN event_id % 3 = 0 THEN 3 ELSE user_id END AS user_id)""",
    "documents": """SELECT * REPLACE (
        CASE WHEN doc_id % 3 = 0 THEN 'one line' || chr(10) || 'two  words' ELSE text END AS text)""",
}
NAMES = (
    "dq_unique dq_fk quarantine_split merge_upsert merge_partition_move erasure_by_ids"
    " erasure_cascade event_log_replay event_log_replay_large_cap metric_cumulative_timestamps"
    " late_arrival_repartition relationalize_rejoin run_expiry impact_downstream row_diff"
).split()


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("skewed"))
    for name in compare.TABLES:
        select = SKEWED.get(name, "SELECT *")
        duckdb.sql(f"COPY ({select} FROM '{SOURCE}/{name}.parquet') TO '{folder}/{name}.parquet'")
    return folder


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, skewed, name, monkeypatch):
    monkeypatch.setattr(skew, "HOT_ROWS", 20)
    df = entry_point.queries()[name](spark, skewed)
    problems = compare.differences(df, compare.connect(skewed), entry_point.oracle_sql()[name])
    assert [p for p in problems if p != "no rows on either side"] == []
