"""Quality checks, quarantine, contracts and governance on data with flaws."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.functions.masks import mask
from lamina.operators import contracts, governance, quality
from lamina.operators.contracts import ColumnContract
from lamina.operators.governance import ColumnPolicy
from lamina.operators.quality import Check
from lamina.suite import Suite, table

suite = Suite()

NOW = datetime(2001, 8, 2)

# Orders with flaws that follow from the data: missing customers, text amounts, a
# repeated (customer, date) pair, customers that are not in good standing.
DIRTY_SQL = """
    SELECT o_orderkey AS order_id,
           CASE WHEN NOT (o_orderstatus = 'P' AND o_totalprice > 400000) THEN o_custkey END
               AS customer_id,
           o_orderdate AS order_date,
           CASE WHEN o_orderpriority = '5-LOW' AND o_totalprice < 20000 THEN 'n/a'
                WHEN o_orderpriority = '1-URGENT' AND o_totalprice < 20000 THEN ' '
                ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS {text}) END AS amount,
           CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '2-HIGH' THEN 'soon'
                ELSE {iso} END AS ordered_at,
           o_orderpriority AS priority
    FROM orders
"""
DIRTY = DIRTY_SQL.format(text="VARCHAR", iso="strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ')")


def dirty_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "orders").createOrReplaceTempView("orders")
    iso = "date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")"
    return spark.sql(DIRTY_SQL.format(text="STRING", iso=iso))


def good_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").filter("c_acctbal >= 0")


NOT_NULL = Check("customer_present", "not_null", column="customer_id")
UNIQUE = Check("one_order_a_day", "uniqueness", columns=("customer_id", "order_date"))
RANGE = Check("amount_range", "range", column="amount", min_value=1000, max_value=450000,
              inclusive_upper=False)
FK = Check("known_customer", "referential_integrity", column="customer_id",
           target_dataset_id="crm.customers", target_column="c_custkey")
FRESH = Check("recent", "freshness", column="ordered_at", max_age_seconds=2000 * 86400)
FORMAT = Check("priority_format", "regex_format", column="priority", pattern="^[1-4]-[A-Z]+$")
ROWS = Check("enough_rows", "row_count_min", row_count_min=100)
CHECKS = (NOT_NULL, UNIQUE, RANGE, FK, FRESH, FORMAT, ROWS)

BAD_NOT_NULL = "customer_id IS NULL"
BAD_UNIQUE = "count(*) OVER (PARTITION BY customer_id, order_date) > 1"
BAD_RANGE = """(trim(amount) <> '' AND (try_cast(amount AS DOUBLE) IS NULL
    OR try_cast(amount AS DOUBLE) < 1000 OR try_cast(amount AS DOUBLE) >= 450000))"""
BAD_FK = """(customer_id IS NOT NULL AND customer_id NOT IN (
    SELECT c_custkey FROM customer WHERE c_acctbal >= 0))"""
AGE = "epoch(TIMESTAMP '2001-08-02' - try_cast(replace(ordered_at, 'Z', '') AS TIMESTAMP))"
BAD_FRESH = f"coalesce({AGE} > 2000 * 86400, true)"
BAD_FORMAT = "NOT regexp_matches(priority, '^[1-4]-[A-Z]+$')"
FLAGGED = f"""
    SELECT *, {BAD_NOT_NULL} AS b1, {BAD_UNIQUE} AS b2, {BAD_RANGE} AS b3, {BAD_FK} AS b4,
           {BAD_FRESH} AS b5, {BAD_FORMAT} AS b6
    FROM ({DIRTY})
"""


def register_check(name: str, check: Check, flag: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        references = {"customers": good_customers(spark, sf_dir)}
        bad = quality.violations(dirty_orders(spark, sf_dir), check, references, NOW)
        return bad.select("order_id", "customer_id", "amount", "priority")

    suite.query(
        f"SELECT order_id, customer_id, amount, priority FROM ({FLAGGED}) WHERE {flag}", name
    )(run)


for _name, _check, _flag in (
    ("dq_not_null", NOT_NULL, "b1"), ("dq_unique", UNIQUE, "b2"), ("dq_range", RANGE, "b3"),
    ("dq_fk", FK, "b4"), ("dq_freshness", FRESH, "b5"), ("dq_regex", FORMAT, "b6"),
):
    register_check(_name, _check, _flag)


@suite.query("""
    SELECT 'enough_rows' AS check_name, 'row_count_min' AS kind, 'orders' AS dataset,
           'pass' AS status, CAST(count(*) AS DOUBLE) AS observed,
           CAST(100 AS DOUBLE) AS expected, CAST(NULL AS VARCHAR) AS message
    FROM orders
""")
def dq_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.evaluate(dirty_orders(spark, sf_dir), [ROWS], dataset="orders")


def _expected(name: str, kind: str, bad: str, observed: str = "", expected: str = "0") -> str:
    observed = observed or f"count(*) FILTER ({bad})"
    return f"""
        SELECT '{name}' AS check_name, '{kind}' AS kind, 'orders' AS dataset,
               CASE WHEN count(*) FILTER ({bad}) > 0 THEN 'fail' ELSE 'pass' END AS status,
               CAST({observed} AS DOUBLE) AS observed, CAST({expected} AS DOUBLE) AS expected,
               CASE WHEN count(*) FILTER ({bad}) > 0 THEN
                   count(*) FILTER ({bad}) || ' of ' || count(*) || ' rows violate' END AS message
        FROM flagged"""


@suite.query(f"WITH flagged AS ({FLAGGED}) " + " UNION ALL ".join([
    _expected("customer_present", "not_null", "b1"),
    _expected("one_order_a_day", "uniqueness", "b2"),
    _expected("amount_range", "range", "b3"),
    _expected("known_customer", "referential_integrity", "b4"),
    _expected("recent", "freshness", "b5", f"max({AGE})", "2000 * 86400"),
    _expected("priority_format", "regex_format", "b6"),
    _expected("enough_rows", "row_count_min", "false", "count(*)", "100"),
]))
def dq_suite_one_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    references = {"customers": good_customers(spark, sf_dir)}
    return quality.evaluate(dirty_orders(spark, sf_dir), CHECKS, references, NOW, "orders")


@suite.query(f"""
    SELECT order_id, concat_ws(',', CASE WHEN b1 THEN 'customer_present' END,
        CASE WHEN b2 THEN 'one_order_a_day' END, CASE WHEN b3 THEN 'amount_range' END,
        CASE WHEN b4 THEN 'known_customer' END, CASE WHEN b5 THEN 'recent' END,
        CASE WHEN b6 THEN 'priority_format' END) AS violations
    FROM ({FLAGGED})
""")
def quarantine_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    references = {"customers": good_customers(spark, sf_dir)}
    clean, bad = quality.split_clean(dirty_orders(spark, sf_dir), CHECKS, references, NOW)
    flagged = bad.select("order_id", F.concat_ws(",", "_violations").alias("violations"))
    return flagged.unionByName(clean.select("order_id", F.lit("").alias("violations")))


@suite.query(f"""
    SELECT 'run-1' AS run_id, 'level3' AS stage, check_name, order_id FROM (
        SELECT order_id, 'customer_present' AS check_name FROM ({FLAGGED}) WHERE b1
        UNION ALL SELECT order_id, 'amount_range' FROM ({FLAGGED}) WHERE b3
        UNION ALL SELECT order_id, 'priority_format' FROM ({FLAGGED}) WHERE b6)
""")
def quarantine_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Violating rows written as JSON by stage and check, then read back."""
    from lamina.session import scratch

    path = scratch(spark, "quarantine")
    _, bad = quality.split_clean(dirty_orders(spark, sf_dir), [NOT_NULL, RANGE, FORMAT])
    records = quality.quarantine_records(
        bad, run_id="run-1", stage="level3", dataset="orders", environment="test",
        captured_at="2024-01-01T00:00:00Z",
    )
    quality.write_quarantine(records, path)
    stored = spark.read.schema(records.schema).json(path)
    order_id = F.from_json("record", "order_id bigint").getField("order_id")
    return stored.select("run_id", "stage", "check_name", order_id.alias("order_id"))


@suite.query("""
    SELECT 'o_custkey' AS column_name, count(*) FILTER (n > 1) AS duplicate_groups
    FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1)
    UNION ALL
    SELECT 'o_totalprice', count(*) FILTER (n > 1)
    FROM (SELECT o_totalprice, count(*) AS n FROM orders GROUP BY 1)
""")
def duplicate_group_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_groups(table(spark, sf_dir, "orders"), ["o_custkey", "o_totalprice"])


@suite.query(f"""
    SELECT 'customer_id' AS column_name, count(*) FILTER (customer_id IS NULL) AS null_count
    FROM ({DIRTY})
    UNION ALL SELECT 'order_id', 0
""")
def column_null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.null_counts(dirty_orders(spark, sf_dir), ["customer_id", "order_id"])


# Customer as a text delivery: some balances are words, some names are missing.
TEXT_SQL = """
    SELECT CAST(c_custkey AS {text}) AS custkey,
           CASE WHEN c_acctbal > 9000 THEN NULL ELSE c_name END AS name,
           CASE WHEN c_acctbal < 0 AND c_mktsegment = 'MACHINERY' THEN 'overdrawn'
                ELSE CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS {text}) END AS acctbal,
           CASE WHEN c_mktsegment = 'BUILDING' AND c_acctbal > 5000 THEN 'unknown'
                ELSE CAST(c_nationkey AS {text}) END AS nation
    FROM customer
"""
TEXT = TEXT_SQL.format(text="VARCHAR")
DECLARED = (
    ColumnContract("custkey", "bigint", False),
    ColumnContract("name", "string", False),
    ColumnContract("acctbal", "decimal(12,2)", True),
    ColumnContract("nation", "integer", True),
)


def text_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "customer").createOrReplaceTempView("customer")
    return spark.sql(TEXT_SQL.format(text="STRING"))


@suite.query(f"""
    WITH c AS ({TEXT})
    SELECT 'custkey' AS column_name, CAST(0 AS BIGINT) AS type_violations,
           CAST(0 AS BIGINT) AS null_violations
    UNION ALL SELECT 'name', 0, (SELECT count(*) FROM c WHERE name IS NULL)
    UNION ALL SELECT 'acctbal', (SELECT count(*) FROM c WHERE acctbal IS NOT NULL
                                 AND try_cast(acctbal AS DECIMAL(12,2)) IS NULL), 0
    UNION ALL SELECT 'nation', (SELECT count(*) FROM c WHERE nation IS NOT NULL
                                AND try_cast(nation AS INTEGER) IS NULL), 0
""")
def contract_conformance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contracts.conformance(text_customers(spark, sf_dir), DECLARED)


@suite.query(f"""
    SELECT CAST(custkey AS BIGINT) AS custkey, name, CAST(acctbal AS DOUBLE) AS acctbal,
           CAST(nation AS INTEGER) AS nation
    FROM ({TEXT})
    WHERE name IS NOT NULL AND acctbal <> 'overdrawn' AND nation <> 'unknown'
""")
def contract_clean_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean, _ = contracts.conform(text_customers(spark, sf_dir), DECLARED)
    return clean.withColumn("acctbal", F.col("acctbal").cast("double"))


@suite.query(f"""
    SELECT custkey, concat_ws(',', CASE WHEN name IS NULL THEN 'name:null' END,
        CASE WHEN acctbal = 'overdrawn' THEN 'acctbal:type' END,
        CASE WHEN nation = 'unknown' THEN 'nation:type' END) AS violations
    FROM ({TEXT})
    WHERE name IS NULL OR acctbal = 'overdrawn' OR nation = 'unknown'
""")
def contract_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, bad = contracts.conform(text_customers(spark, sf_dir), DECLARED)
    return bad.select("custkey", F.concat_ws(",", "_violations").alias("violations"))


# Personal columns derived from the customer row.
PII_SQL = """
    SELECT c_custkey, c_name,
           CASE WHEN c_mktsegment = 'FURNITURE' THEN c_name
                ELSE lower(replace(c_name, '#', '.')) || '@example.com' END AS email,
           substr({digits}, 1, 3) || '-' || substr({digits}, 4, 2) || '-'
               || substr({digits}, 6, 4) AS ssn,
           CAST(c_custkey AS {text}) AS code, c_mktsegment AS segment
    FROM customer
"""
PII = PII_SQL.format(digits="lpad(CAST(c_custkey AS VARCHAR), 9, '0')", text="VARCHAR")


def personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "customer").createOrReplaceTempView("customer")
    digits = "lpad(CAST(c_custkey AS STRING), 9, '0')"
    return spark.sql(PII_SQL.format(digits=digits, text="STRING"))


EMAIL_SQL = """CASE WHEN contains(email, '@') THEN
    CASE WHEN length(split_part(email, '@', 1)) <= 2 THEN repeat('*', length(split_part(email, '@', 1)))
         ELSE substr(split_part(email, '@', 1), 1, 1)
              || repeat('*', length(split_part(email, '@', 1)) - 2)
              || right(split_part(email, '@', 1), 1) END
    || '@' || split_part(email, '@', 2) ELSE repeat('*', length(email)) END"""
SSN_SQL = "'***-**-' || right(regexp_replace(ssn, '\\D', '', 'g'), 4)"
MIDDLE_SQL = """CASE WHEN length({c}) <= 4 THEN repeat('*', length({c}))
    ELSE substr({c}, 1, 1) || repeat('*', greatest(length({c}) - 2, 2)) || right({c}, 1) END"""
END_SQL = """CASE WHEN length({c}) <= {k} THEN repeat('*', length({c}))
    ELSE substr({c}, 1, {k}) || repeat('*', greatest(length({c}) - {k}, 2)) END"""


def register_mask(name: str, strategy: str, column: str, sql: str, tier: str | None = None) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        masked = mask(F.col(column), strategy, tier)
        return personal(spark, sf_dir).select("c_custkey", masked.alias("masked"))

    suite.query(f"SELECT c_custkey, {sql} AS masked FROM ({PII})", name)(run)


register_mask("mask_none", "none", "segment", "segment")
register_mask("mask_nullify", "nullify", "segment", "CAST(NULL AS VARCHAR)")
register_mask("mask_hash", "hash_sha256", "ssn", "sha256(ssn)")
register_mask("mask_email", "redact_email", "email", EMAIL_SQL)
register_mask("mask_ssn", "redact_ssn", "ssn", SSN_SQL)
register_mask("mask_truncate_middle", "truncate_middle", "code", MIDDLE_SQL.format(c="code"))
register_mask("mask_truncate_end", "truncate_end", "c_name", END_SQL.format(c="c_name", k=8))
register_mask("mask_truncate_end_confidential", "truncate_end", "segment",
              END_SQL.format(c="segment", k=4), "confidential")

POLICIES = (
    ColumnPolicy("c_custkey", "public", "none"),
    ColumnPolicy("email", "restricted_pii", "redact_email"),
    ColumnPolicy("ssn", "restricted_pii"),
    ColumnPolicy("segment", "internal", "truncate_end"),
)


@suite.query(f"""
    SELECT 'analyst' AS viewer, c_custkey, {END_SQL.format(c="c_name", k=4)} AS c_name,
           {EMAIL_SQL} AS email, CAST(NULL AS VARCHAR) AS ssn,
           {END_SQL.format(c="code", k=4)} AS code, {END_SQL.format(c="segment", k=8)} AS segment
    FROM ({PII})
    UNION ALL
    SELECT 'officer', c_custkey, c_name, email, ssn, code, segment FROM ({PII})
""")
def mask_view_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One view under two roles; columns without a policy follow the table's tier."""
    def view(viewer: str, roles: tuple[str, ...]) -> DataFrame:
        masked = governance.masked_view(
            personal(spark, sf_dir), POLICIES, "confidential", "privacy_officer", roles
        )
        return masked.withColumn("viewer", F.lit(viewer))

    return view("analyst", ()).unionByName(view("officer", ("privacy_officer",)))


@suite.query("""
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date FROM orders
    WHERE NOT o_orderdate < DATE '2001-08-01' - INTERVAL 1000 DAY
""")
def retention_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("order_date")
    )
    return governance.retain(rows, "order_date", 1000, date(2001, 8, 1))


@suite.query("""
    SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
    WHERE NOT (o_orderstatus = 'P' AND o_orderpriority = '5-LOW')
""")
def erasure_by_condition(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return governance.erase_where(rows, {"o_orderstatus": "P", "o_orderpriority": "5-LOW"})


@suite.query("""
    SELECT c_custkey, c_name FROM customer
    WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 450000)
""")
def erasure_by_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = table(spark, sf_dir, "orders").filter("o_totalprice > 450000").select("o_custkey")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return governance.erase_ids(customers, "c_custkey", ids)


@suite.query("""
    SELECT 'orders' AS layer, o_orderkey AS id, CAST(0 AS INTEGER) AS line FROM orders
    WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)
    UNION ALL
    SELECT 'lines', l_orderkey, l_linenumber FROM lineitem
    WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_custkey IN (
        SELECT c_custkey FROM customer WHERE c_acctbal < 0))
""")
def erasure_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Erase customers' orders by customer id and every line of those orders."""
    ids = table(spark, sf_dir, "customer").filter("c_acctbal < 0").select("c_custkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    left = governance.erase_cascade(
        orders, {"lines": (lines, "l_orderkey")}, "o_custkey", ids, "o_orderkey"
    )
    kept_orders = left["parent"].select(
        F.lit("orders").alias("layer"), F.col("o_orderkey").alias("id"), F.lit(0).alias("line")
    )
    kept_lines = left["lines"].select(
        F.lit("lines").alias("layer"), F.col("l_orderkey").alias("id"),
        F.col("l_linenumber").alias("line"),
    )
    return kept_orders.unionByName(kept_lines)
