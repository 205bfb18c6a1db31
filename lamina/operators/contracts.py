"""Schema contracts: compare declared columns with a schema, and rows with declared types."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MODES = ("strict", "warn", "off")
# other spellings of Spark's own type names
ALIASES = {"INTEGER": "INT", "LONG": "BIGINT", "SHORT": "SMALLINT", "BYTE": "TINYINT"}


class ContractViolation(Exception):
    pass


@dataclass(frozen=True)
class ColumnContract:
    name: str
    type: str | None = None
    nullable: bool | None = None


@dataclass(frozen=True)
class ContractDiff:
    """Names only in the schema, names only in the contract, and what differs in the others."""

    added: tuple[str, ...] = ()
    removed: tuple[str, ...] = ()
    changed: tuple[dict, ...] = ()

    def __bool__(self) -> bool:
        return bool(self.added or self.removed or self.changed)


def contract_type(dtype: T.DataType) -> str:
    return dtype.simpleString().upper()


def declared_type(text: str) -> str:
    compact = "".join(text.split()).upper()
    return ALIASES.get(compact, compact)


def compare_columns(
    spark: SparkSession, declared: Sequence[ColumnContract], schema: T.StructType, check_nullable: bool = True
) -> DataFrame:
    """Contract and schema side by side, one row per differing column.

    (column_name, status, expected_type, actual_type, expected_nullable, actual_nullable);
    the last four are set where that property differs. An undeclared property agrees with any.
    """
    kind = "column_name string, type string, nullable boolean"
    wanted = [(c.name, declared_type(c.type) if c.type else None, c.nullable if check_nullable else None) for c in declared]
    found = [(f.name, contract_type(f.dataType), f.nullable) for f in schema.fields]
    side = {"want": wanted, "have": found}
    tables = [spark.createDataFrame(v, kind).select("column_name", F.struct("type", "nullable").alias(k)) for k, v in side.items()]
    both = tables[0].join(tables[1], "column_name", "full_outer")
    unlike = {p: F.coalesce(F.col(f"want.{p}") != F.col(f"have.{p}"), F.lit(False)) for p in ("type", "nullable")}
    status = (
        F.when(F.col("want").isNull(), "added")
        .when(F.col("have").isNull(), "removed")
        .when(unlike["type"] | unlike["nullable"], "changed")
    )
    shown = [
        F.when((status == "changed") & unlike[p], F.col(f"{s}.{p}")).alias(f"{label}_{p}")
        for p in unlike for label, s in (("expected", "want"), ("actual", "have"))
    ]
    return both.select("column_name", status.alias("status"), *shown).filter(F.col("status").isNotNull())


def diff(
    declared: Sequence[ColumnContract], schema: T.StructType, check_nullable: bool = True
) -> ContractDiff:
    """``compare_columns`` as a value; column order does not matter."""
    spark = SparkSession.getActiveSession()
    rows = sorted(compare_columns(spark, declared, schema, check_nullable).collect(), key=lambda r: r["column_name"])
    named = {s: tuple(r["column_name"] for r in rows if r["status"] == s) for s in ("added", "removed")}
    changed = tuple(
        {"column": r["column_name"], **{k: v for k, v in r.asDict().items() if k not in ("column_name", "status")}}
        for r in rows if r["status"] == "changed"
    )
    return ContractDiff(**named, changed=changed)


def enforce(
    declared: Sequence[ColumnContract],
    output: T.StructType,
    existing: T.StructType | None = None,
    mode: str = "off",
) -> list[tuple[str, ContractDiff]]:
    """Compare with the output schema and the existing table.

    ``strict`` raises, ``warn`` returns what differs, ``off`` looks at nothing. Parquet
    tables read back as nullable, so nullability is compared on the output only.
    """
    if mode not in MODES:
        raise ValueError(f"unknown contract mode {mode!r}")
    if mode == "off" or not declared:
        return []
    found = [("dataframe_schema", diff(declared, output))]
    if existing is not None:
        found.append(("catalog_schema", diff(declared, existing, check_nullable=False)))
    found = [(where, d) for where, d in found if d]
    if found and mode == "strict":
        raise ContractViolation("; ".join(f"{where}: {d}" for where, d in found))
    return found


def cell_problem(contract: ColumnContract, present: bool = True) -> Column:
    """Null when the value fits; otherwise what is wrong with it. An absent column is null in every row."""
    value = F.col(contract.name) if present else F.lit(None).cast("string")
    problem = F.when(F.lit(contract.nullable is False) & value.isNull(), F.lit("null"))
    if contract.type:
        cast = value.try_cast(declared_type(contract.type))
        problem = problem.when(value.isNotNull() & cast.isNull(), F.lit("type"))
    return problem


def conformance(df: DataFrame, declared: Sequence[ColumnContract]) -> DataFrame:
    """Per declared column the number of type and null violations, in one pass."""
    aggregates = []
    for c in declared:
        problem = cell_problem(c, c.name in df.columns)
        aggregates.append(
            F.struct(
                F.lit(c.name).alias("column_name"),
                F.count_if(F.coalesce(problem == "type", F.lit(False))).alias("type_violations"),
                F.count_if(F.coalesce(problem == "null", F.lit(False))).alias("null_violations"),
            )
        )
    return df.agg(F.array(*aggregates).alias("rows")).select(F.inline("rows"))


def enforce_rows(
    df: DataFrame, declared: Sequence[ColumnContract], mode: str = "off"
) -> tuple[DataFrame, DataFrame | None]:
    """(rows to go on with, violating rows): ``strict`` raises on any, ``off`` looks at none."""
    if mode not in MODES:
        raise ValueError(f"unknown contract mode {mode!r}")
    if mode == "off":
        return df, None
    clean, bad = conform(df, declared)
    if mode == "strict" and not bad.isEmpty():
        raise ContractViolation("some rows do not fit the declared types")
    return clean, bad


def conform(
    df: DataFrame, declared: Sequence[ColumnContract]
) -> tuple[DataFrame, DataFrame]:
    """(rows in the declared types, violating rows with ``_violations``)."""
    by_name: Mapping[str, ColumnContract] = {c.name: c for c in declared}
    problems = []
    for c in declared:
        problem = cell_problem(c, c.name in df.columns)
        problems.append(F.when(problem.isNotNull(), F.concat(F.lit(f"{c.name}:"), problem)))
    flagged = df.withColumn("_violations", F.array_compact(F.array(*problems)).cast("array<string>"))
    casts = []
    for name in df.columns:
        contract = by_name.get(name)
        value = F.col(name)
        if contract is not None and contract.type:
            value = value.try_cast(declared_type(contract.type))
        casts.append(value.alias(name))
    clean = flagged.filter(F.size("_violations") == 0).select(*casts)
    return clean, flagged.filter(F.size("_violations") > 0)
