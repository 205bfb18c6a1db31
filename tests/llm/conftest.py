import pytest

from lamina.llm.common import ship


@pytest.fixture(autouse=True)
def sources_on_workers(spark):
    ship(spark)


#: Names that operators use inside or return.
CLASHING = "'x' AS id, 'y' AS fp, 1 AS label, 2 AS size, 'k' AS key, 3 AS score, 4 AS copies, 5 AS shard, 6 AS ids"


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text, source) with extra columns whose names the operators use, too."""

    def make(rows):
        rows = [(r + (None,) * 3)[:3] for r in rows]
        df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
        return df.selectExpr("doc_id", "text", "'en' AS lang", "source", "length(text) AS n_chars", *CLASHING.split(", "))

    return make
