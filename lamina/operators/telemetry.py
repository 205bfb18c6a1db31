"""Run audit rows to metric points and alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AUDIT_SCHEMA = (
    "run_id string, stage string, job_name string, environment string, trigger_type string,"
    " status string, started_at timestamp_ntz, completed_at timestamp_ntz,"
    " records_read bigint, records_written bigint, files_written bigint,"
    " extra map<string,double>, validations array<struct<check_name:string,status:string>>,"
    " error_code string"
)
LABELS = ["stage", "job_name", "environment", "trigger_type", "status"]


def _point(name: Column, kind: str, value: Column, labels: Column) -> Column:
    return F.struct(
        name.alias("metric_name"),
        F.lit(kind).alias("metric_type"),
        value.cast("double").alias("value"),
        labels.alias("labels"),
    )


def run_metrics(audit: DataFrame) -> DataFrame:
    """Metric points of every run: duration, counts, status, extras and validations."""
    pairs = [x for name in LABELS for x in (F.lit(name), F.col(name))]
    audit = audit.withColumn("__labels", F.create_map(*pairs))
    labels = F.col("__labels")
    micros = F.timestamp_diff("MICROSECOND", F.col("started_at"), F.col("completed_at"))
    fixed = F.array(
        _point(F.lit("run_duration_seconds"), "gauge", micros / 1000000, labels),
        _point(F.lit("records_read_total"), "counter", F.col("records_read"), labels),
        _point(F.lit("records_written_total"), "counter", F.col("records_written"), labels),
        _point(F.lit("files_written_total"), "counter", F.col("files_written"), labels),
        _point(F.lit("run_status"), "gauge",
               F.when(F.col("status") == "success", 1).otherwise(0), labels),
    )
    known = F.filter(fixed, lambda p: p["value"].isNotNull())
    clean = lambda key: F.regexp_replace(F.lower(key), "[^a-z0-9_]+", "_")
    extras = F.transform(
        F.map_entries("extra"),
        lambda e: _point(F.concat(F.lit("extra_"), clean(e["key"])), "gauge", e["value"], labels),
    )
    checks = F.transform(
        "validations",
        lambda v: _point(
            F.lit("validation_result"), "counter", F.lit(1),
            F.map_concat(labels, F.create_map(
                F.lit("validation_status"), F.coalesce(v["status"], F.lit("unknown")),
                F.lit("check_name"), F.coalesce(v["check_name"], F.lit("unnamed")),
            )),
        ),
    )
    empty = F.array().cast(
        "array<struct<metric_name:string,metric_type:string,value:double,labels:map<string,string>>>"
    )
    every = F.concat(known, F.coalesce(extras, empty), F.coalesce(checks, empty))
    return audit.select("run_id", F.inline(every))


def alerts(audit: DataFrame) -> DataFrame:
    """Failed runs; a retry or time-out code is a warning, anything else critical."""
    soft = F.upper("error_code").rlike("RETRY|TIMEOUT")
    return audit.filter(F.col("status") != "success").select(
        "run_id",
        F.when(soft, "warning").otherwise("critical").alias("severity"),
        F.concat_ws(" ", F.lit("run failed:"), "stage", "job_name").alias("message"),
        F.create_map(
            *[x for name in LABELS for x in (F.lit(name), F.col(name))],
            F.lit("error_code"), F.col("error_code"),
        ).alias("labels"),
    )
