"""Data-quality checks over DataFrames.

All row-local checks of a suite share one aggregate; uniqueness and foreign keys count
keys map-side and then work on distinct keys only, so a hot key costs one row per task.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.functions import coerce
from lamina.operators.skew import hot_hashes, lookup_join

RESULT_COLUMNS = (
    "check_name", "kind", "dataset", "status", "observed", "expected", "message",
)


class QualityFailure(Exception):
    def __init__(self, failed: list):
        super().__init__("; ".join(f"{r['check_name']}: {r['message']}" for r in failed))
        self.failed = failed


@dataclass(frozen=True)
class Check:
    """One declared check; ``kind`` selects which of the fields apply."""

    check_name: str
    kind: str
    column: str | None = None
    columns: tuple[str, ...] = ()
    min_value: float | None = None
    max_value: float | None = None
    inclusive_lower: bool = True
    inclusive_upper: bool = True
    target_dataset_id: str | None = None
    target_column: str | None = None
    max_age_seconds: float | None = None
    pattern: str | None = None
    row_count_min: int | None = None
    dataset_id: str | None = None

    def __post_init__(self):
        lo, hi = self.min_value, self.max_value
        if lo is not None and hi is not None and hi < lo:
            raise ValueError(f"{self.check_name}: max_value is below min_value")


# kind -> fields it needs; the names a suite document uses
KINDS = {
    "not_null": ("column",),
    "uniqueness": ("columns",),
    "range": ("column",),
    "referential_integrity": ("column", "target_dataset_id", "target_column"),
    "freshness": ("column", "max_age_seconds"),
    "regex_format": ("column", "pattern"),
    "row_count_min": ("row_count_min",),
}
ROW_LOCAL = ("not_null", "range", "freshness", "regex_format")


def check_from_dict(item: Mapping) -> Check:
    values = dict(item)
    for alias in ("source_column", "timestamp_column"):
        if alias in values:
            values["column"] = values.pop(alias)
    if "columns" in values:
        values["columns"] = tuple(values["columns"])
    check = Check(**values)
    if check.kind not in KINDS:
        raise ValueError(f"{check.check_name}: unknown kind {check.kind!r}")
    missing = [f for f in KINDS[check.kind] if not getattr(check, f) and getattr(check, f) != 0]
    if missing:
        raise ValueError(f"{check.check_name}: missing {missing}")
    return check


def load_suite(text: str) -> list[Check]:
    """Checks from JSON or YAML text: a list, or a list under ``checks``/``quality_checks``."""
    try:
        raw = json.loads(text)
    except json.JSONDecodeError:
        import yaml

        raw = yaml.safe_load(text)
    if isinstance(raw, dict):
        raw = raw.get("checks") or raw.get("quality_checks") or []
    if raw is None:
        raw = []
    if not isinstance(raw, list):
        raise ValueError("a suite is a list, or an object with a list under 'checks'")
    return [check_from_dict(item) for item in raw]


def applies_to(check: Check, *dataset_names: str) -> bool:
    return check.dataset_id is None or check.dataset_id in dataset_names


def _utc_micros(now: datetime | None) -> int:
    now = now or datetime.now(timezone.utc)
    if now.tzinfo is None:
        now = now.replace(tzinfo=timezone.utc)
    delta = now - datetime(1970, 1, 1, tzinfo=timezone.utc)
    return (delta.days * 86400 + delta.seconds) * 1000000 + delta.microseconds


def _age_micros(check: Check, schema: T.StructType, now: datetime | None) -> Column:
    stamp = coerce.as_epoch_micros(F.col(check.column), schema[check.column].dataType)
    return F.lit(_utc_micros(now)) - stamp


def row_rule(check: Check, schema: T.StructType, now: datetime | None = None) -> Column:
    """True where the row violates a row-local check; never null."""
    if check.kind not in ROW_LOCAL:
        raise ValueError(f"{check.kind} does not look at one row at a time")
    if check.column not in schema.names:
        return F.lit(check.kind == "not_null")
    column, dtype = F.col(check.column), schema[check.column].dataType
    if check.kind == "not_null":
        return column.isNull()
    if check.kind == "regex_format":
        if not isinstance(dtype, T.StringType):
            return column.isNotNull()
        return F.coalesce(~column.rlike(check.pattern), F.lit(False))
    if check.kind == "freshness":
        age = _age_micros(check, schema, now)
        stale = age > int(check.max_age_seconds * 1000000)
        return column.isNotNull() & F.coalesce(stale, F.lit(True))
    number = coerce.as_number(column, dtype)
    bounds = []
    if check.min_value is not None:
        low = F.lit(float(check.min_value))
        bounds.append(number < low if check.inclusive_lower else number <= low)
    if check.max_value is not None:
        high = F.lit(float(check.max_value))
        bounds.append(number > high if check.inclusive_upper else number >= high)
    if not bounds:
        return F.lit(False)
    outside = bounds[0] if len(bounds) == 1 else bounds[0] | bounds[1]
    return ~coerce.is_blank(column, dtype) & F.coalesce(~F.isnan(number) & outside, F.lit(True))


def _key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def _repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that break uniqueness with their row count: seen twice, or all null."""
    all_null = F.lit(True)
    for k in keys:
        all_null = all_null & F.col(k).isNull()
    return _key_counts(df, keys).filter((F.col("n") > 1) | all_null)


def _orphan_keys(df: DataFrame, check: Check, target: DataFrame) -> DataFrame:
    """Non-null keys absent from the target with their row count."""
    counts = _key_counts(df.filter(F.col(check.column).isNotNull()), [check.column])
    known = target.select(F.col(check.target_column).alias("__known")).distinct()
    return counts.join(known, F.col(check.column) == F.col("__known"), "left_anti")


def _target(check: Check, references: Mapping[str, DataFrame]) -> DataFrame | None:
    wanted = check.target_dataset_id
    return references.get(wanted, references.get(wanted.split(".")[-1]))


def _with_key_columns(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """A key column the data lacks counts as null in every row."""
    wanted = [k for c in checks if c.kind == "uniqueness" for k in c.columns]
    wanted += [c.column for c in checks if c.kind == "referential_integrity"]
    missing = {k: F.lit(None).cast("string") for k in wanted if k not in df.columns}
    return df.withColumns(missing) if missing else df


def violations(
    df: DataFrame,
    check: Check,
    references: Mapping[str, DataFrame] | None = None,
    now: datetime | None = None,
) -> DataFrame:
    """The violating rows, unchanged."""
    if check.kind in ROW_LOCAL:
        return df.filter(row_rule(check, df.schema, now))
    flagged = flag_violations(df, [check], references, now)
    return flagged.filter(F.size("_violations") > 0).drop("_violations")


def flag_violations(
    df: DataFrame,
    checks: Sequence[Check],
    references: Mapping[str, DataFrame] | None = None,
    now: datetime | None = None,
) -> DataFrame:
    """``df`` plus ``_violations``, the names of the checks each row breaks.

    ``df`` is read once per uniqueness or foreign-key check besides the result itself, so
    it should be a stored table or a cheap view of one.
    """
    references = references or {}
    original, df = df, _with_key_columns(df, checks)
    out, flags = df, []
    for i, check in enumerate(checks):
        flag = f"__bad_{i}"
        if check.kind in ROW_LOCAL:
            rule = row_rule(check, original.schema, now)
        elif check.kind == "uniqueness":
            keys = list(check.columns)
            bad = _repeated_keys(df, keys).select(*keys, F.lit(True).alias(flag))
            out = lookup_join(out, bad, keys, null_safe=True, hot=hot_hashes(df, keys))
            rule = F.coalesce(F.col(flag), F.lit(False))
        elif check.kind == "referential_integrity" and _target(check, references) is not None:
            keys = [check.column]
            bad = _orphan_keys(df, check, _target(check, references)).select(
                *keys, F.lit(True).alias(flag)
            )
            out = lookup_join(out, bad, keys, hot=hot_hashes(df, keys))
            rule = F.coalesce(F.col(flag), F.lit(False))
        else:
            continue
        flags.append(F.when(rule, F.lit(check.check_name)))
    names = F.array_compact(F.array(*flags)) if flags else F.array().cast("array<string>")
    return out.select(*original.columns, names.alias("_violations"))


def _result_row(check: Check, dataset: str, observed: Column, failed: Column, total: Column):
    expected = {
        "freshness": check.max_age_seconds,
        "row_count_min": check.row_count_min,
    }.get(check.kind, 0)
    if check.kind == "range" and check.min_value is None and check.max_value is None:
        status, message = F.lit("skipped"), F.lit("no bounds")
    else:
        status = F.when(failed > 0, F.lit("fail")).otherwise(F.lit("pass"))
        message = F.when(
            failed > 0, F.format_string("%d of %d rows violate", failed, total)
        )
    return F.struct(
        F.lit(check.check_name).alias("check_name"),
        F.lit(check.kind).alias("kind"),
        F.lit(dataset).alias("dataset"),
        status.alias("status"),
        observed.cast("double").alias("observed"),
        F.lit(float(expected)).alias("expected"),
        message.alias("message"),
    )


def evaluate(
    df: DataFrame,
    checks: Sequence[Check],
    references: Mapping[str, DataFrame] | None = None,
    now: datetime | None = None,
    dataset: str = "dataset",
) -> DataFrame:
    """One result row per check."""
    references = references or {}
    results: list[DataFrame] = []
    one_pass = [c for c in checks if c.kind in ROW_LOCAL or c.kind == "row_count_min"]
    if one_pass:
        aggregates = [F.count(F.lit(1)).alias("total")]
        for i, c in enumerate(one_pass):
            if c.kind == "row_count_min":
                continue
            aggregates.append(F.count_if(row_rule(c, df.schema, now)).alias(f"bad_{i}"))
            if c.kind == "freshness" and c.column in df.columns:
                aggregates.append(F.max(_age_micros(c, df.schema, now)).alias(f"age_{i}"))
        counted = df.agg(*aggregates)
        rows = []
        for i, c in enumerate(one_pass):
            total = F.col("total")
            if c.kind == "row_count_min":
                short = F.when(total < c.row_count_min, total.cast("bigint")).otherwise(0)
                few = F.when(total < c.row_count_min, 1).otherwise(0)
                rows.append(_result_row(c, dataset, total, few, F.greatest(total, short)))
                continue
            bad = F.col(f"bad_{i}")
            observed = bad
            if c.kind == "freshness":
                has_age = f"age_{i}" in counted.columns
                observed = F.col(f"age_{i}") / 1000000 if has_age else F.lit(None)
            rows.append(_result_row(c, dataset, observed, bad, total))
        results.append(counted.select(F.inline(F.array(*rows))))
    df = _with_key_columns(df, checks)
    for c in checks:
        if c in one_pass:
            continue
        if c.kind == "uniqueness":
            keys, total = list(c.columns), F.sum("n")
            all_null = F.lit(True)
            for k in keys:
                all_null = all_null & F.col(k).isNull()
            bad = F.sum(F.when((F.col("n") > 1) | all_null, F.col("n")).otherwise(0))
            counted = _key_counts(df, keys).agg(
                F.coalesce(total, F.lit(0)).alias("total"), F.coalesce(bad, F.lit(0)).alias("bad")
            )
        else:
            target = _target(c, references)
            if target is None:
                results.append(_skipped(df, c, dataset))
                continue
            counts = _key_counts(df, [c.column])
            known = target.select(
                F.col(c.target_column).alias("__known"), F.lit(True).alias("__hit")
            ).distinct()
            joined = counts.join(known, F.col(c.column) == F.col("__known"), "left")
            orphan = F.col(c.column).isNotNull() & F.col("__hit").isNull()
            counted = joined.agg(
                F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
                F.coalesce(F.sum(F.when(orphan, F.col("n"))), F.lit(0)).alias("bad"),
            )
        row = _result_row(c, dataset, F.col("bad"), F.col("bad"), F.col("total"))
        results.append(counted.select(F.inline(F.array(row))))
    if not results:
        return df.sparkSession.createDataFrame([], RESULT_SCHEMA)
    out = results[0]
    for r in results[1:]:
        out = out.unionByName(r)
    return out


RESULT_SCHEMA = (
    "check_name string, kind string, dataset string, status string,"
    " observed double, expected double, message string"
)


def _skipped(df: DataFrame, check: Check, dataset: str) -> DataFrame:
    row = (check.check_name, check.kind, dataset, "skipped", None, 0.0,
           f"{check.target_dataset_id} was not supplied")
    return df.sparkSession.createDataFrame([row], RESULT_SCHEMA)


def split_clean(
    df: DataFrame,
    checks: Sequence[Check],
    references: Mapping[str, DataFrame] | None = None,
    now: datetime | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(clean rows, violating rows with ``_violations``)."""
    flagged = flag_violations(df, checks, references, now)
    clean = flagged.filter(F.size("_violations") == 0).drop("_violations")
    return clean, flagged.filter(F.size("_violations") > 0)


def quarantine_records(
    bad: DataFrame, *, run_id: str, stage: str, dataset: str, environment: str, captured_at: str
) -> DataFrame:
    """One record per violating row and check, the row kept whole as JSON."""
    payload = [c for c in bad.columns if c != "_violations"]
    return bad.select(
        F.lit(captured_at).alias("captured_at"),
        F.lit(run_id).alias("run_id"),
        F.lit(stage).alias("stage"),
        F.lit(dataset).alias("dataset"),
        F.lit(environment).alias("environment"),
        F.explode("_violations").alias("check_name"),
        F.to_json(F.struct(*payload), {"ignoreNullFields": "false"}).alias("record"),
    )


def write_quarantine(records: DataFrame, path: str) -> None:
    records.write.mode("append").partitionBy("stage", "check_name").json(path)


def enforce(results: DataFrame, policy: str = "best_effort") -> list:
    """Result rows (one per declared check); raises under ``blocking`` if any failed."""
    if policy not in ("best_effort", "blocking"):
        raise ValueError(f"unknown policy {policy!r}")
    rows = results.collect()
    failed = [r for r in rows if r["status"] == "fail"]
    if failed and policy == "blocking":
        raise QualityFailure(failed)
    return rows


def model_expectations(
    row_count_min: int | None = None,
    unique_columns: Sequence[str] = (),
    not_null_columns: Sequence[str] = (),
) -> list[Check]:
    """The checks a SQL model declares about its output."""
    checks = []
    if row_count_min is not None:
        checks.append(Check("row_count_min", "row_count_min", row_count_min=row_count_min))
    checks += [Check(f"unique:{c}", "uniqueness", columns=(c,)) for c in unique_columns]
    checks += [Check(f"not_null:{c}", "not_null", column=c) for c in not_null_columns]
    return checks


def duplicate_groups(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column, how many values occur more than once (null counts as a value)."""
    parts = []
    for c in columns:
        repeated = _key_counts(df, [c]).filter(F.col("n") > 1)
        parts.append(
            repeated.agg(F.count(F.lit(1)).alias("duplicate_groups")).select(
                F.lit(c).alias("column_name"), "duplicate_groups"
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column null count, all columns in one pass."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counted.unpivot([], list(columns), "column_name", "null_count")
