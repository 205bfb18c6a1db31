"""Semantic metrics: a declared aggregation over a model's column by dimensions."""

from __future__ import annotations

import fnmatch
import hashlib
import json
import re
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.operators.loads import LoadResult, load
from lamina.operators.parity import row_differences
from lamina.session import staged

AGGREGATIONS = ("sum", "count_distinct", "average", "min", "max", "cumulative_rolling")


@dataclass(frozen=True)
class Dimension:
    name: str
    is_time_dimension: bool = False


@dataclass(frozen=True)
class Metric:
    domain: str
    name: str
    query_ref: str
    aggregation: str
    dimensions: tuple[Dimension, ...] = ()
    filters: tuple[str, ...] = ()
    rolling_periods: int | None = None  # cumulative_rolling: None accumulates from the start
    rolling_days: int | None = None  # cumulative_rolling: days of calendar time up to each row's

    def __post_init__(self):
        if not re.fullmatch(r"[A-Za-z_]\w*", self.name):
            raise ValueError(f"bad metric name {self.name!r}")
        if self.aggregation not in AGGREGATIONS:
            raise ValueError(f"{self.name}: unknown aggregation {self.aggregation!r}")
        if len(self.query_ref.split(".")) != 4:
            raise ValueError(f"{self.name}: query_ref is stage.domain.model.column")
        names = [d.name for d in self.dimensions]
        if len(set(names)) < len(names):
            raise ValueError(f"{self.name}: repeated dimension")
        if self.aggregation == "cumulative_rolling" and self.time_dimension is None:
            raise ValueError(f"{self.name}: cumulative_rolling needs a time dimension")
        spans = [n for n in (self.rolling_periods, self.rolling_days) if n is not None]
        if len(spans) > 1 or any(n < 1 for n in spans):
            raise ValueError(f"{self.name}: rolling takes one number of periods or days")

    @property
    def id(self) -> str:
        return f"{self.domain}.{self.name}"

    @property
    def column(self) -> str:
        return self.query_ref.split(".")[3]

    @property
    def model_id(self) -> str:
        return ".".join(self.query_ref.split(".")[:3])

    @property
    def dims(self) -> list[str]:
        return sorted(d.name for d in self.dimensions)

    @property
    def time_dimension(self) -> str | None:
        return next((d.name for d in self.dimensions if d.is_time_dimension), None)

    @property
    def definition_hash(self) -> str:
        """One hash of the whole definition, filters included."""
        spec = asdict(self)
        if self.rolling_days is None:
            del spec["rolling_days"]
        return hashlib.sha256(json.dumps(spec, sort_keys=True).encode()).hexdigest()

    @property
    def table_name(self) -> str:
        return f"metric_{self.domain}_{self.name}"


def metric_from_dict(spec: Mapping) -> Metric:
    dims = tuple(
        Dimension(d["name"], bool(d.get("is_time_dimension"))) for d in spec.get("dimensions") or ()
    )
    filters = tuple(f["predicate"] if isinstance(f, Mapping) else f
                    for f in spec.get("filters") or ())
    return Metric(spec["domain"], spec["name"], spec["query_ref"], spec["aggregation"], dims,
                  filters, spec.get("rolling_periods"), spec.get("rolling_days"))


def discover(package: str, pattern: str = "*") -> list[Metric]:
    """Metrics under ``<package>/metrics/<domain>/<name>/`` whose id matches ``pattern``."""
    found = []
    for manifest in sorted(Path(package).glob("metrics/*/*/manifest.*")):
        text = manifest.read_text(encoding="utf-8")
        if manifest.suffix == ".json":
            spec = json.loads(text)
        else:
            import yaml

            spec = yaml.safe_load(text)
        metric = metric_from_dict(spec)
        if (metric.domain, metric.name) != manifest.parent.parts[-2:]:
            raise ValueError(f"{manifest}: manifest says {metric.id}")
        found.append(metric)
    return [m for m in found if fnmatch.fnmatch(m.id, pattern)]


def check_declared(metric: Metric, governed_columns: Mapping[str, Sequence[str]]) -> None:
    """The metric's column must be declared by its model."""
    if metric.column not in governed_columns.get(metric.model_id, ()):
        raise ValueError(f"{metric.id}: {metric.query_ref} is not a declared column")


def _aggregate(metric: Metric) -> Column:
    column = F.col(metric.column)
    return {
        "sum": F.sum,
        "cumulative_rolling": F.sum,
        "average": F.avg,
        "min": F.min,
        "max": F.max,
        "count_distinct": F.count_distinct,
    }[metric.aggregation](column)


def compute(df: DataFrame, metric: Metric) -> DataFrame:
    """Dimensions in name order plus the metric; one global row without dimensions."""
    for predicate in metric.filters:
        df = df.filter(predicate)
    grouped = df.groupBy(*metric.dims).agg(_aggregate(metric).alias(metric.name))
    if metric.aggregation != "cumulative_rolling":
        return grouped
    return _accumulate(grouped, metric)


def _accumulate(grouped: DataFrame, metric: Metric) -> DataFrame:
    """Running or rolling total over the time dimension within the other dimensions.

    Times of any ordered type are dealt into ranges first. A window holds the rows of one range and,
    for rolling totals, the rows of the neighbouring one that its first rows still count; it never
    holds a dimension tuple's whole history.
    """
    time = metric.time_dimension
    others = [d for d in metric.dims if d != time]
    name = metric.name
    if metric.rolling_days is not None:
        return _rolling(grouped, others, *_calendar(grouped, time, metric.rolling_days), name).select(*metric.dims, name)
    ranged = dealt(grouped, others, time)
    if metric.rolling_periods is None:
        before = before_in_order(ranged, F.col(name), others, time)
        return before.select(*metric.dims, (F.col("__before") + F.col(name)).alias(name))
    placed = before_in_order(ranged, F.lit(1), others, time)
    return _rolling(placed, others, F.col("__before"), metric.rolling_periods, name).select(*metric.dims, name)


#: Places that a range of rolling totals holds at least.
PLACES = 4096


def _calendar(rows: DataFrame, time: str, days: int) -> tuple[Column, int]:
    """A time dimension as a number, and ``days`` in its unit."""
    kind, column = rows.schema[time].dataType, F.col(time)
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("bigint"), days
    if isinstance(kind, T.TimestampNTZType):
        column = column.cast("timestamp")
    elif not isinstance(kind, T.TimestampType):
        raise ValueError(f"{time}: calendar time needs dates or times, not {kind.simpleString()}")
    return F.unix_micros(column), days * 86_400_000_000


def _rolling(rows: DataFrame, others: Sequence[str], place: Column, reach: int, name: str) -> DataFrame:
    """``rows`` with ``name`` summed over the places from ``reach`` - 1 before each row's place.

    Places are cut into ranges as long as the reach; each range also gets the rows of the one before
    that its first places reach, so a row is copied once at most. Rows without a place
    count among themselves.
    """
    width = max(reach, PLACES)
    own = F.floor(F.col("__place") / width)
    ahead = F.floor((F.col("__place") + reach - 1) / width)
    copies = F.when(F.col("__place").isNull(), F.array(own)).otherwise(F.array_distinct(F.array(own, ahead)))
    spread = rows.withColumn("__place", place).withColumn("__own", own).withColumn("__part", F.explode(copies))
    window = W.partitionBy(*others, "__part").orderBy("__place").rangeBetween(1 - reach, W.currentRow)
    summed = spread.withColumn(name, F.sum(name).over(window))
    return summed.where(F.col("__part").eqNullSafe(F.col("__own"))).drop("__place", "__own", "__part")


def dealt(rows: DataFrame, others: Sequence[str], order: str) -> DataFrame:
    """``rows`` in ranges of ``others`` and ``order``, written once, with the number of the range."""
    ranged = rows.repartitionByRange(*others, order).withColumn("__range", F.spark_partition_id())
    return staged(ranged, "running")


def before_in_order(ranged: DataFrame, value: Column, others: Sequence[str], order: str) -> DataFrame:
    """``ranged`` plus ``__before``: the total of ``value`` over all earlier rows of the same ``others``."""
    earlier = (W.unboundedPreceding, -1)
    rows = ranged.withColumn("__value", value)
    totals = rows.groupBy(*others, "__range").agg(F.sum("__value").alias("__sum"))
    window = W.partitionBy(*others).orderBy("__range").rowsBetween(*earlier)
    totals = totals.withColumn("__ranges", F.coalesce(F.sum("__sum").over(window), F.lit(0)))
    window = W.partitionBy(*others, "__range").orderBy(order).rowsBetween(*earlier)
    inner = rows.withColumn("__inner", F.coalesce(F.sum("__value").over(window), F.lit(0)))
    joined = inner.alias("a").join(totals.alias("b"), _dims_match([*others, "__range"]))
    total = (F.col("__ranges") + F.col("__inner")).alias("__before")
    return joined.select(*[F.col(f"a.{c}") for c in ranged.columns if c != "__range"], total)


def _dims_match(names: Sequence[str]) -> Column:
    out = F.lit(True)
    for n in names:
        out = out & F.col(f"a.{n}").eqNullSafe(F.col(f"b.{n}"))
    return out


def materialize(df: DataFrame, metric: Metric, folder: str) -> LoadResult:
    """Write the metric as a table and report the rows written."""
    return load(compute(df, metric), f"{folder}/{metric.table_name}")


def create_view(df: DataFrame, metric: Metric) -> str:
    compute(df, metric).createOrReplaceTempView(metric.table_name)
    return metric.table_name


def points(df: DataFrame, metric: Metric) -> DataFrame:
    """One gauge per dimension tuple, the dimensions as labels."""
    labels = [x for d in metric.dims for x in (F.lit(d), F.col(d).cast("string"))]
    empty = F.create_map().cast("map<string,string>")
    return compute(df, metric).select(
        F.lit(f"metric.{metric.id}").alias("metric_name"),
        F.lit("gauge").alias("metric_type"),
        (F.create_map(*labels) if labels else empty).alias("labels"),
        F.col(metric.name).cast("double").alias("value"),
    )


def audit_stats(df: DataFrame, metric: Metric) -> DataFrame:
    """Totals of the computed metric for its audit row."""
    value = F.col(metric.name).cast("double")
    return compute(df, metric).agg(
        F.sum(value).alias("total_sum"),
        F.count(value).alias("non_null_count"),
        F.min(value).alias("min_value"),
        F.max(value).alias("max_value"),
    ).select(
        F.lit(metric.id).alias("metric_id"),
        F.lit(metric.definition_hash).alias("definition_hash"),
        "total_sum", "non_null_count", "min_value", "max_value",
    )


def differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that two ways of serving a metric do not share; empty when they agree."""
    return row_differences(left, right)


def write_audit(stats: DataFrame, path: str, mode: str, run_id: str, finished_at: str) -> None:
    """Append the audit row of one metric run."""
    row = stats.withColumns(
        {"mode": F.lit(mode), "run_id": F.lit(run_id), "finished_at": F.lit(finished_at)}
    )
    row.write.mode("append").parquet(path)
