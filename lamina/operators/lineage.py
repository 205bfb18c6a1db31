"""Column lineage of a DataFrame, lineage events, edges and impact analysis."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lamina.operators.skew import hot_hashes, lookup_join
from lamina.session import scratch, staged

FIELD = "struct<namespace:string,name:string,field:string>"
EVENT_SCHEMA = (
    "event_type string, event_time string, run_id string, job_name string,"
    " inputs array<struct<namespace:string,name:string>>,"
    " outputs array<struct<namespace:string,name:string,facets:struct<"
    "schema:array<struct<name:string,type:string>>,"
    f"columnLineage:struct<fields:map<string,struct<inputFields:array<{FIELD}>>>>>>>"
)


def _items(scala_seq) -> list:
    return [scala_seq.apply(i) for i in range(scala_seq.size())]


def _merge(into: dict, more: dict) -> dict:
    for key, value in more.items():
        into[key] = into.get(key, frozenset()) | value
    return into


def column_lineage(df: DataFrame, datasets: Mapping[str, str]) -> dict[str, list[tuple[str, str]]]:
    """Output column -> sorted [(dataset, column)] it is computed from.

    ``datasets`` maps view names to dataset names. Follows expression ids through
    Spark's own analyzed plan (classic Spark only: the plan is read over py4j).
    """
    plan = df._jdf.queryExecution().analyzed()
    common: dict[int, tuple] = {}
    known = _trace(plan, datasets, common)
    return {
        a.name(): sorted(known.get(a.exprId().id(), frozenset())) for a in _items(plan.output())
    }


def _trace(node, datasets, common) -> dict:
    """Expression id -> origins, for everything visible at or below ``node``."""
    kind = node.getClass().getSimpleName()
    if kind == "SubqueryAlias" and node.alias() in datasets:
        name = datasets[node.alias()]
        return {a.exprId().id(): frozenset([(name, a.name())]) for a in _items(node.output())}
    if kind == "WithCTE":
        for definition in _items(node.cteDefs()):
            inner = _trace(definition.child(), datasets, common)
            ids = [a.exprId().id() for a in _items(definition.child().output())]
            common[definition.id()] = [inner.get(i, frozenset()) for i in ids]
        return _trace(node.plan(), datasets, common)
    if kind == "CTERelationRef":
        ids = [a.exprId().id() for a in _items(node.output())]
        return dict(zip(ids, common.get(node.cteId(), [])))
    known: dict = {}
    below = [_trace(child, datasets, common) for child in _items(node.children())]
    for part in below:
        _merge(known, part)
    if kind in ("Union", "Intersect", "Except"):
        rows = [[a.exprId().id() for a in _items(c.output())] for c in _items(node.children())]
        for position, out in enumerate(_items(node.output())):
            merged = frozenset().union(
                *[part.get(row[position], frozenset()) for part, row in zip(below, rows)]
            )
            known[out.exprId().id()] = merged
        return known
    if kind == "Project":
        named = _items(node.projectList())
    elif kind == "Aggregate":
        named = _items(node.aggregateExpressions())
    elif kind == "Window":
        named = _items(node.windowExpressions())
    elif kind == "Expand":
        for row in _items(node.projections()):
            for out, expr in zip(_items(node.output()), _items(row)):
                _merge(known, {out.exprId().id(): _origins(expr, known)})
        return known
    elif kind == "Generate":
        found = _origins(node.generator(), known)
        return _merge(known, {a.exprId().id(): found for a in _items(node.generatorOutput())})
    else:
        return known
    return {**known, **{e.exprId().id(): _origins(e, known) for e in named}}


def _origins(expression, known) -> frozenset:
    if expression.getClass().getSimpleName() == "AttributeReference":
        return known.get(expression.exprId().id(), frozenset())
    attributes = _items(expression.references().toSeq())
    return frozenset().union(*[known.get(a.exprId().id(), frozenset()) for a in attributes])


def run_event(
    spark: SparkSession,
    event_type: str,
    event_time: str,
    run_id: str,
    job_name: str,
    inputs: Sequence[str],
    output: str,
    df: DataFrame | None = None,
    lineage: Mapping[str, Sequence[tuple[str, str]]] | None = None,
    namespace: str = "lamina",
) -> DataFrame:
    """One START, COMPLETE or FAIL event as a row of the events table."""
    if event_type not in ("START", "COMPLETE", "FAIL"):
        raise ValueError(f"unknown event type {event_type!r}")
    fields = {
        column: ([(namespace, d, c) for d, c in origins],)
        for column, origins in (lineage or {}).items()
    }
    schema = [(f.name, f.dataType.simpleString()) for f in df.schema.fields] if df else []
    row = (
        event_type, event_time, run_id, job_name,
        [(namespace, i) for i in inputs],
        [(namespace, output, (schema, (fields,)))],
    )
    return spark.createDataFrame([row], EVENT_SCHEMA)


#: Events in a file: a compressed file is read by one task.
FILE_EVENTS = 1_000_000


def write_events(events: DataFrame, path: str) -> None:
    """Event lines, compressed: they repeat names and long keys, and take about a tenth of their text."""
    writer = events.write.option("compression", "gzip").option("maxRecordsPerFile", FILE_EVENTS)
    # the fastest level of gzip; its output is hardly larger
    writer.option("zlib.compress.level", "BEST_SPEED").json(path)


def read_events(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Event lines; lines that are not JSON objects are skipped."""
    reader = spark.read.schema(EVENT_SCHEMA).option("mode", "DROPMALFORMED")
    return reader.json(paths).filter(F.col("event_type").isNotNull())


def _qualified(item: Column, namespace: str) -> Column:
    """Name alone in the home namespace, else ``namespace:name``."""
    home = item["namespace"].isNull() | (item["namespace"] == namespace)
    return F.when(home, item["name"]).otherwise(
        F.concat(item["namespace"], F.lit(":"), item["name"])
    )


def table_edges(events: DataFrame, namespace: str = "lamina") -> DataFrame:
    """Distinct (source, target) datasets of completed runs."""
    done = events.filter(F.col("event_type") == "COMPLETE")
    outs = done.select("inputs", F.explode("outputs").alias("o"))
    pairs = outs.select("o", F.explode("inputs").alias("i"))
    return pairs.select(
        _qualified(F.col("i"), namespace).alias("source"),
        _qualified(F.col("o"), namespace).alias("target"),
    ).distinct()


def column_edges(events: DataFrame, namespace: str = "lamina") -> DataFrame:
    """Distinct column edges from the column-lineage facets of completed runs."""
    done = events.filter(F.col("event_type") == "COMPLETE")
    outs = done.select(F.explode("outputs").alias("o"))
    fields = outs.select("o", F.explode("o.facets.columnLineage.fields").alias("column", "facet"))
    origins = fields.select("o", "column", F.explode("facet.inputFields").alias("i"))
    return origins.select(
        _qualified(F.col("i"), namespace).alias("source"),
        F.col("i.field").alias("source_column"),
        _qualified(F.col("o"), namespace).alias("target"),
        F.col("column").alias("target_column"),
    ).distinct()


def impact(edges: DataFrame, start: str, direction: str, depth: int = 5) -> DataFrame:
    """(node, depth) of everything within ``depth`` steps; the start itself is excluded.

    ``edges`` holds (source, target).
    """
    starts = edges.sparkSession.createDataFrame([(start,)], "start string")
    return impact_of_many(edges, starts, direction, depth).select("node", "depth")


def impact_of_many(edges: DataFrame, starts: DataFrame, direction: str, depth: int = 5) -> DataFrame:
    """(start, node, depth): the least number of steps from each start to everything it reaches.

    ``starts`` has one column, of any number of nodes; repeated and null ones count once and not at all. A start
    is not part of its own reach, cycles end where they meet it. Each level is one join of the edges with the
    frontier of all starts; nodes with very many edges are spread over tasks, found once. Levels are
    written to the shared folder, by depth, so lineage stays short.
    """
    if depth < 1:
        raise ValueError("depth must be at least 1")
    if direction not in ("upstream", "downstream"):
        raise ValueError(f"unknown direction {direction!r}")
    here, there = ("source", "target") if direction == "downstream" else ("target", "source")
    spark = edges.sparkSession
    steps = staged(edges.select(F.col(here).alias("here"), F.col(there).alias("there")).distinct(), "impact-edges", codec="zstd")
    hot = hot_hashes(steps, ["here"])
    found = scratch(spark, f"impact-{direction}")
    schema = "start string, node string, depth int"

    def add(rows: DataFrame) -> int:
        seen = Observation()
        rows.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("append").partitionBy("depth").parquet(found)
        return seen.get["n"]

    first = starts.select(F.col(starts.columns[0]).alias("start")).where("start is not null").distinct()
    reached = add(first.select("start", F.col("start").alias("node"), F.lit(0).alias("depth")))
    for level in range(1, depth + 1):
        if not reached:
            break
        visited = spark.read.schema(schema).parquet(found)
        frontier = visited.where(F.col("depth") == level - 1).select("start", F.col("node").alias("here"))
        new = lookup_join(steps, frontier, ["here"], "inner", hot=hot)
        new = new.select("start", F.col("there").alias("node")).distinct()
        new = new.join(visited.select("start", "node"), ["start", "node"], "left_anti")
        reached = add(new.withColumn("depth", F.lit(level)))
    return spark.read.schema(schema).parquet(found).where(F.col("depth") > 0)


def column_impact(edges: DataFrame, column: str, direction: str, depth: int = 5) -> DataFrame:
    """(dataset, column, depth) reached from ``dataset.column``."""
    if "." not in column:
        raise ValueError("the column is given as <dataset>.<column>")
    nodes = edges.select(
        F.concat_ws(".", "source", "source_column").alias("source"),
        F.concat_ws(".", "target", "target_column").alias("target"),
    )
    found = impact(nodes, column, direction, depth)
    name = F.substring_index("node", ".", -1)
    dataset = F.left(F.col("node"), F.length("node") - F.length(name) - 1)
    return found.select(dataset.alias("dataset"), name.alias("column"), "depth")
