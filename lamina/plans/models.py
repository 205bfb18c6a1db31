"""SQL models: manifest plus a SELECT, run in dependency order with Spark SQL."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date, datetime, timezone
from functools import reduce
from graphlib import CycleError, TopologicalSorter
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from lamina import storage
from lamina.operators import contracts, governance, lineage, quality, telemetry
from lamina.operators.loads import LoadResult, default_partitions, load, read_table

STAGES = ("level3", "level4")
TOKEN = re.compile(r"\{\{\s*([A-Za-z0-9_.]+)\s*\}\}")


@dataclass(frozen=True)
class SourceRef:
    logical_name: str
    source_name: str
    entity_name: str
    table_name: str | None = None
    environment: str | None = None


@dataclass(frozen=True)
class Model:
    stage: str
    domain: str
    name: str
    sql: str
    table: str
    load_mode: str = "full_refresh"
    partition_columns: tuple[str, ...] = ()
    depends_on: tuple[str, ...] = ()
    sources: tuple[SourceRef, ...] = ()
    row_count_min: int | None = None
    unique_columns: tuple[str, ...] = ()
    not_null_columns: tuple[str, ...] = ()
    contract: str = "off"
    contract_columns: tuple[contracts.ColumnContract, ...] = ()
    quality_policy: str = "blocking"
    classification: str | None = None
    policies: tuple[governance.ColumnPolicy, ...] = ()

    def __post_init__(self):
        if self.stage not in STAGES:
            raise ValueError(f"{self.name}: unknown stage {self.stage!r}")
        if not re.fullmatch(r"[A-Za-z_]\w*", self.table):
            raise ValueError(f"{self.name}: bad table name {self.table!r}")
        if self.sources and self.stage != "level3":
            raise ValueError(f"{self.name}: only level3 models read sources")
        if self.quality_policy not in ("blocking", "best_effort"):
            raise ValueError(f"{self.name}: unknown quality policy {self.quality_policy!r}")
        names = [s.logical_name for s in self.sources]
        if len(set(names)) < len(names):
            raise ValueError(f"{self.name}: repeated source name")

    @property
    def id(self) -> str:
        return f"{self.stage}.{self.domain}.{self.name}"


@dataclass
class ModelRun:
    model_id: str
    load: LoadResult
    checks: list = field(default_factory=list)
    contract_warnings: list = field(default_factory=list)
    inputs: list[str] = field(default_factory=list)
    lineage: dict[str, list[tuple[str, str]]] = field(default_factory=dict)


def _parse(text: str) -> dict:
    try:
        return json.loads(text)
    except json.JSONDecodeError:
        import yaml

        return yaml.safe_load(text)


def discover(
    package: str,
    stage: str | None = None,
    domain: str | None = None,
    name: str | None = None,
) -> list[Model]:
    """Models under ``<package>/<stage>/<domain>/<name>/`` whose folder matches the manifest."""
    found = []
    for manifest in sorted(Path(package).glob("level[34]/*/*/manifest.*")):
        if manifest.suffix not in (".yaml", ".yml", ".json"):
            continue
        folder = manifest.parent
        spec = _parse(manifest.read_text(encoding="utf-8"))
        model = model_from_dict(spec, (folder / "model.sql").read_text(encoding="utf-8"))
        if (model.stage, model.domain, model.name) != folder.parts[-3:]:
            raise ValueError(f"{manifest}: manifest says {model.id}")
        found.append(model)
    wanted = {"stage": stage, "domain": domain, "name": name}
    return [
        m for m in found if all(v is None or getattr(m, k) == v for k, v in wanted.items())
    ]


def model_from_dict(spec: Mapping, sql: str) -> Model:
    target, checks = spec["target"], spec.get("quality") or {}
    governed = spec.get("governance") or {}
    columns = governed.get("columns") or []
    return Model(
        stage=spec["stage"],
        domain=spec["domain"].strip(),
        name=spec["name"].strip(),
        sql=sql,
        table=target["table_name"].strip(),
        load_mode=spec.get("load_mode", "full_refresh"),
        partition_columns=tuple(target.get("partition_columns") or ()),
        depends_on=tuple(dict.fromkeys(d.strip() for d in spec.get("depends_on") or ())),
        sources=tuple(SourceRef(**s) for s in spec.get("sources") or ()),
        row_count_min=checks.get("row_count_min"),
        unique_columns=tuple(checks.get("unique_columns") or ()),
        not_null_columns=tuple(checks.get("not_null_columns") or ()),
        contract=spec.get("contract", "off"),
        contract_columns=tuple(
            contracts.ColumnContract(c["name"], c.get("type"), c.get("nullable")) for c in columns
        ),
        quality_policy=checks.get("policy", "blocking"),
        classification=governed.get("classification"),
        policies=tuple(
            governance.ColumnPolicy(c["name"], c.get("classification"), c.get("masking")) for c in columns
        ),
    )


def token_context(
    environment: str,
    run_id: str,
    window_start: date | None = None,
    window_end: date | None = None,
    partition: Mapping | None = None,
    extra: Mapping | None = None,
) -> dict:
    context = {
        "environment": environment,
        "run_id": run_id,
        "window": {"start_date": window_start, "end_date": window_end},
        "partition": dict(partition or {}),
    }
    return _merged(context, extra or {})


def _merged(base: Mapping, over: Mapping) -> dict:
    out = dict(base)
    for key, value in over.items():
        both = isinstance(value, Mapping) and isinstance(out.get(key), Mapping)
        out[key] = _merged(out[key], value) if both else value
    return out


def compile_sql(model: Model, context: Mapping) -> str:
    """Fill ``{{ a.b }}`` tokens; a missing or non-scalar value is an error, null is empty."""
    own = {"model": {"stage": model.stage, "domain": model.domain, "name": model.name,
                     "id": model.id, "table_name": model.table}}
    if model.sources:
        first = model.sources[0]
        own["source"] = {
            "logical_name": first.logical_name,
            "source_name": first.source_name,
            "entity_name": first.entity_name,
        }
    values = _merged(own, context)

    def fill(match: re.Match) -> str:
        value: object = values
        for part in match.group(1).split("."):
            if not isinstance(value, Mapping) or part not in value:
                raise KeyError(f"{model.id}: unknown token {match.group(1)}")
            value = value[part]
        if isinstance(value, (Mapping, list, tuple, set)):
            raise ValueError(f"{model.id}: token {match.group(1)} is not a single value")
        return "" if value is None else str(value)

    return TOKEN.sub(fill, model.sql)


def dependency_ids(model: Model) -> list[str]:
    """References of one, two or three parts; missing parts default to the model's own."""
    own = [model.stage, model.domain]
    out = []
    for ref in model.depends_on:
        parts = ref.split(".")
        if len(parts) > 3:
            raise ValueError(f"{model.id}: bad reference {ref!r}")
        out.append(".".join([*own[: 3 - len(parts)], *parts]))
    return out


def with_dependencies(selected: Sequence[Model], everything: Sequence[Model]) -> list[Model]:
    by_id = {m.id: m for m in everything}
    todo, seen = [m.id for m in selected], {}
    while todo:
        model_id = todo.pop()
        if model_id in seen:
            continue
        if model_id not in by_id:
            raise ValueError(f"unknown model {model_id}")
        seen[model_id] = by_id[model_id]
        todo += dependency_ids(by_id[model_id])
    return list(seen.values())


def in_order(models: Sequence[Model]) -> list[Model]:
    """Dependencies first, ties by id."""
    by_id = {m.id: m for m in models}
    sorter = TopologicalSorter()
    for m in models:
        needs = dependency_ids(m)
        unknown = [d for d in needs if d not in by_id]
        if unknown:
            raise ValueError(f"{m.id}: unknown dependencies {unknown}")
        sorter.add(m.id, *needs)
    try:
        sorter.prepare()
    except CycleError as error:
        raise ValueError(f"models depend on each other: {error.args[1]}") from None
    out = []
    while sorter.is_active():
        for model_id in sorted(sorter.get_ready()):
            out.append(by_id[model_id])
            sorter.done(model_id)
    return out


def table_path(warehouse: str, model: Model) -> str:
    return f"{warehouse}/{model.stage}/{model.table}"


class Runner:
    """Runs models against a warehouse folder; ``read_source`` resolves level-3 inputs.

    With ``quarantine_path`` the rows that break a check are written there, whether the model's
    policy then blocks the load or lets it go on. With ``audit_path`` every model leaves an audit
    row (``telemetry.AUDIT_SCHEMA``), failed ones included.
    """

    def __init__(
        self,
        spark: SparkSession,
        warehouse: str,
        context: Mapping,
        read_source: Callable[[SourceRef], DataFrame],
        quarantine_path: str | None = None,
        audit_path: str | None = None,
    ):
        self.spark = spark
        self.warehouse = warehouse
        self.context = context
        self.read_source = read_source
        self.quarantine_path = quarantine_path
        self.audit_path = audit_path
        self.outputs: dict[str, DataFrame] = {}
        self._tables: dict[str, str] = {}
        self.runs: list[ModelRun] = []

    def frame(self, model: Model) -> DataFrame:
        """The model's SELECT with its inputs registered as views."""
        for ref in model.sources:
            self.read_source(ref).createOrReplaceTempView(ref.logical_name)
        for dep in dependency_ids(model):
            if dep not in self.outputs:
                raise ValueError(f"{model.id}: {dep} has not run")
            self.outputs[dep].createOrReplaceTempView(self._tables[dep])
        return self.spark.sql(compile_sql(model, self.context))

    def run(self, models: Sequence[Model]) -> list[ModelRun]:
        """Fail-fast; ``runs`` holds what finished before an error."""
        ordered = in_order(models)
        self._tables = {m.id: m.table for m in ordered}
        for model in ordered:
            started = datetime.now(timezone.utc).replace(tzinfo=None)
            try:
                done = self._run_one(model)
            except Exception as error:
                self._audit(model, "failed", started, None, [], type(error).__name__)
                raise
            self.runs.append(done)
            self._audit(model, "success", started, done.load.rows_written, done.checks, None)
        return self.runs

    def _audit(self, model: Model, status: str, started: datetime, rows: int | None, checks: list, error: str | None):
        if not self.audit_path:
            return
        finished = datetime.now(timezone.utc).replace(tzinfo=None)
        row = (
            str(self.context.get("run_id")), "sql", model.id, str(self.context.get("environment")), "manual", status,
            started, finished, None, rows, None, None, [(r["check_name"], r["status"]) for r in checks], error,
        )
        self.spark.createDataFrame([row], telemetry.AUDIT_SCHEMA).write.mode("append").parquet(self.audit_path)

    def _quarantine(self, model: Model, staged: DataFrame, checks: list) -> None:
        row_checks = [c for c in checks if c.kind != "row_count_min"]
        if not self.quarantine_path or not row_checks:
            return
        _, bad = quality.split_clean(staged, row_checks)
        records = quality.quarantine_records(
            bad, run_id=str(self.context.get("run_id")), stage=model.stage, dataset=model.id,
            environment=str(self.context.get("environment")), captured_at=datetime.now(timezone.utc).isoformat(),
        )
        quality.write_quarantine(records, self.quarantine_path)

    def masked(self, model: Model, unmask_role: str | None = None, active_roles: Sequence[str] = ()) -> DataFrame:
        """A finished model's output under the classification and maskings of its manifest."""
        return governance.masked_view(
            self.outputs[model.id], model.policies, model.classification, unmask_role, active_roles
        )

    def _run_one(self, model: Model) -> ModelRun:
        df = self.frame(model)
        path = table_path(self.warehouse, model)
        existing = None
        if model.contract != "off" and storage.has_files(self.spark, path):
            existing = self.spark.read.parquet(path).schema
        warnings = contracts.enforce(model.contract_columns, df.schema, existing, model.contract)
        checks = quality.model_expectations(
            model.row_count_min, model.unique_columns, model.not_null_columns
        )
        rows: list = []

        def validate(staged: DataFrame) -> None:
            rows.extend(quality.enforce(quality.evaluate(staged, checks), "best_effort"))
            failed = [r for r in rows if r["status"] == "fail"]
            if failed:
                self._quarantine(model, staged, checks)
            if failed and model.quality_policy == "blocking":
                raise quality.QualityFailure(failed)

        parts = default_partitions(model.stage, model.load_mode, model.partition_columns)
        done = load(df, path, model.load_mode, parts, validate if checks else None)
        self.outputs[model.id] = read_table(self.spark, path, df.schema)
        datasets = self._datasets(model)
        return ModelRun(
            model.id, done, rows, warnings, sorted(datasets.values()),
            lineage.column_lineage(df, datasets),
        )

    def _datasets(self, model: Model) -> dict[str, str]:
        """View name -> dataset name of the model's inputs."""
        sources = {r.logical_name: f"{r.source_name}.{r.entity_name}" for r in model.sources}
        return {**sources, **{self._tables[d]: self._tables[d] for d in dependency_ids(model)}}

    def lineage_events(self, event_time: str) -> DataFrame:
        """A COMPLETE event per finished model with its column lineage."""
        events = [
            lineage.run_event(
                self.spark, "COMPLETE", event_time, str(self.context.get("run_id")), run.model_id,
                run.inputs, self._tables[run.model_id], self.outputs[run.model_id], run.lineage,
            )
            for run in self.runs
        ]
        return reduce(DataFrame.unionByName, events)

    def explain(self, models: Sequence[Model]) -> dict[str, str]:
        """Formatted plan per model; writes nothing. Dependants see a zero-row result."""
        ordered = in_order(models)
        self._tables = {m.id: m.table for m in ordered}
        plans = {}
        for model in ordered:
            df = self.frame(model)
            plans[model.id] = df._sc._jvm.PythonSQLUtils.explainString(
                df._jdf.queryExecution(), "formatted"
            )
            self.outputs[model.id] = df.limit(0)
        return plans
