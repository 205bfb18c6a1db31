"""Every registered query against its SQL at the smallest scale."""

import __spark_entry__ as entry_point
import compare
import pytest

from lamina.operators import relational

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry_point.queries(), entry_point.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    if name in ORACLES:
        problems = [p for p in compare.differences(df, con, ORACLES[name]) if p != "no rows on either side"]
        assert problems == []
    else:
        assert df.count() > 0


def test_nested_documents_are_bounded(spark, monkeypatch):
    made, relationalize = [], relational.relationalize
    monkeypatch.setattr(relational, "relationalize", lambda df, *a, **k: made.append(df) or relationalize(df, *a, **k))
    rows = QUERIES["map_and_nested_arrays"](spark, SF_DIR).count()
    sizes = made[0].selectExpr("max(size(prices))", "max(size(pairs))", "sum(size(pairs))").first()
    assert sizes[0] <= 50 and sizes[1] <= 50 and sizes[2] == rows


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.columns == ["order_date", "total_amount"] and df.count() > 0
