"""Mergeable sketches per partition: distinct counts and quantiles of all days from those of each day.

A sketch table holds one row per partition and key: the number of rows, a theta sketch for each
distinct count and a KLL sketch for each quantile column. When a day arrives or changes, only its
rows are read and only its sketches are written; totals over any days merge the stored sketches.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.operators.loads import LoadResult, load
from lamina.operators.metrics import Metric, before_in_order, dealt

ROWS = "rows"


@dataclass(frozen=True)
class SketchSpec:
    """What to sketch: names of results and the columns they are taken of.

    A theta sketch of 2**``entries_log2`` entries is exact up to about as many distinct values; beyond, its
    relative error is at most ``distinct_error`` in 95 of 100 cases. The true rank of a quantile of a KLL sketch
    of size ``k`` is off by at most ``rank_error`` of the rows in 99 of 100 cases.
    """

    distinct: Mapping[str, str] = field(default_factory=dict)
    quantiles: Mapping[str, str] = field(default_factory=dict)
    entries_log2: int = 14
    k: int = 800

    def __post_init__(self):
        names = [ROWS, *self.distinct, *self.quantiles]
        if len(set(names)) < len(names):
            raise ValueError("names of sketches repeat")

    @property
    def distinct_error(self) -> float:
        return 2 / (2**self.entries_log2 - 1) ** 0.5

    @property
    def rank_error(self) -> float:
        # fixed values: the published error fit of KLL sketches
        return 2.296 / self.k**0.9723


def sketch_rows(df: DataFrame, spec: SketchSpec, keys: Sequence[str]) -> DataFrame:
    """Sketches of ``df`` per ``keys``. Nulls are not counted; a group of nulls has empty sketches."""
    parts = [F.count(F.lit(1)).alias(ROWS)]
    parts += [F.theta_sketch_agg(F.col(f"`{c}`"), spec.entries_log2).alias(n) for n, c in spec.distinct.items()]
    parts += [
        F.kll_sketch_agg_double(F.col(f"`{c}`").cast("double"), spec.k).alias(n) for n, c in spec.quantiles.items()
    ]
    return df.groupBy(*keys).agg(*parts)


def store_partitions(
    df: DataFrame, path: str, spec: SketchSpec, keys: Sequence[str], partition_columns: Sequence[str]
) -> LoadResult:
    """Write the sketches of the partitions that ``df`` holds; each replaces what it had before.

    ``df`` holds whole partitions: a late row means that its partition is read again.
    """
    rows = sketch_rows(df, spec, [*partition_columns, *keys])
    return load(rows, path, "partition_overwrite", list(partition_columns))


def merged(sketches: DataFrame, spec: SketchSpec, keys: Sequence[str]) -> DataFrame:
    """Sketches per ``keys`` over all given partitions."""
    parts = [F.sum(ROWS).alias(ROWS)]
    parts += [F.theta_union_agg(F.col(f"`{n}`"), spec.entries_log2).alias(n) for n in spec.distinct]
    parts += [F.kll_merge_agg_double(F.col(f"`{n}`")).alias(n) for n in spec.quantiles]
    return sketches.groupBy(*keys).agg(*parts)


def estimates(
    sketches: DataFrame, spec: SketchSpec, keys: Sequence[str], probabilities: Sequence[float] = (0.5,)
) -> DataFrame:
    """Rows, distinct counts and quantiles (an array in the order of ``probabilities``) per ``keys``.

    A quantile column without values gives null.
    """
    whole = merged(sketches, spec, keys)
    wanted = F.array(*[F.lit(float(p)) for p in probabilities])
    columns = [F.theta_sketch_estimate(F.col(f"`{n}`")).alias(n) for n in spec.distinct]
    for name in spec.quantiles:
        sketch = F.col(f"`{name}`")
        filled = F.kll_sketch_get_n_double(sketch) > 0
        columns.append(F.when(filled, F.kll_sketch_get_quantile_double(sketch, wanted)).alias(name))
    return whole.select(*keys, ROWS, *columns)


def common(left: DataFrame, right: DataFrame, spec: SketchSpec, keys: Sequence[str]) -> DataFrame:
    """Distinct values per ``keys`` that occur in both sets of partitions."""
    a, b = (merged(side, spec, keys) for side in (left, right))
    a = a.select(*[F.col(k).alias(f"__{k}") for k in keys], *[F.col(f"`{n}`").alias(f"__{n}") for n in spec.distinct])
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"__{k}").eqNullSafe(F.col(k))
    both = [
        F.theta_sketch_estimate(F.theta_intersection(F.col(f"`__{n}`"), F.col(f"`{n}`"))).alias(n) for n in spec.distinct
    ]
    return b.join(a, same).select(*keys, *both)


def metric_spec(metric: Metric, **sizes: int) -> SketchSpec:
    """The sketch of a distinct-count metric."""
    if metric.aggregation != "count_distinct":
        raise ValueError(f"{metric.id}: only distinct counts are kept as sketches")
    return SketchSpec(distinct={metric.name: metric.column}, **sizes)


def store_metric(df: DataFrame, metric: Metric, path: str, partition_columns: Sequence[str], **sizes: int) -> LoadResult:
    """Add the partitions that ``df`` holds to the metric's sketches; other partitions are not read."""
    for predicate in metric.filters:
        df = df.filter(predicate)
    keys = [d for d in metric.dims if d not in partition_columns]
    return store_partitions(df, path, metric_spec(metric, **sizes), keys, partition_columns)


def read_metric(spark: SparkSession, metric: Metric, path: str, **sizes: int) -> DataFrame:
    """The metric by its dimensions, merged over all partitions."""
    found = estimates(spark.read.parquet(path), metric_spec(metric, **sizes), metric.dims)
    return found.select(*metric.dims, metric.name)


def exact_quantiles(
    df: DataFrame, keys: Sequence[str], column: str, probabilities: Mapping[str, float]
) -> DataFrame:
    """Exact quantiles of ``column`` per ``keys``, one column for each name of ``probabilities``.

    The quantile p of n values is the least with ceil(p * n) values up to it, at least one. Values are counted,
    sorted into ranges and numbered by totals of the ranges before, so no task holds a group. Nulls are not
    values; a group of nulls alone has no row.
    """
    if any(not 0 <= p <= 1 for p in probabilities.values()):
        raise ValueError("probabilities lie between 0 and 1")
    counts = df.where(F.col(column).isNotNull()).groupBy(*keys, F.col(column).alias("__at"))
    counts = counts.agg(F.count(F.lit(1)).alias("__n"))
    placed = before_in_order(dealt(counts, keys, "__at"), F.col("__n"), keys, "__at")
    # the last value of a group has all others before it
    sizes = placed.groupBy(*keys).agg(F.max(F.col("__before") + F.col("__n")).alias("__size"))
    joined = placed.alias("a").join(sizes.alias("b"), _same(keys))
    joined = joined.select(*[F.col(f"a.{k}") for k in keys], "__at", "__n", "__before", "__size")

    def chosen(p: float) -> Column:
        rank = F.greatest(F.ceil(F.lit(float(p)) * F.col("__size")), F.lit(1))
        return F.when((F.col("__before") < rank) & (rank <= F.col("__before") + F.col("__n")), F.col("__at"))

    return joined.groupBy(*keys).agg(*[F.max(chosen(p)).alias(name) for name, p in probabilities.items()])


def _same(keys: Sequence[str]) -> Column:
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
    return same
