"""URL filter: rules by host and path, and a tree of path templates for everything else.

Each host has a tree of path segments, as deep as its paths. Segments that look variable (numbers,
dates, hashes) become wildcards. Other branches below one node are merged on evidence only: those that
go on alike and have all their labels blocked, all allowed, or both in shares that an exact test does
not tell apart. Branches that are wholly blocked and wholly allowed never share a template. Where most
URLs have a segment of their own, the next URL will bring a new one: if no labels below the node
contradict each other, all its branches become one wildcard. A template's share of blocked labels,
smoothed towards the share of all labels, decides what its unlabelled URLs get; without labels
of its own it is never rejected. Labels are the rules' own verdicts unless a label column is given.

Paths are aggregated before anything else, and the tree is grown level by level as joins of
counted nodes, so a host with a third of all URLs is not one task's work. What has no branches any
more is finished at once, however deep it goes on.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import Staged, shuffles_removed
from lamina.operators.skew import lookup_join
from lamina.session import scratch

#: Segments that are variable by their form, with the wildcard that stands for them.
SHAPES = (
    (r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$", "{date}"),
    (r"^[0-9]+(\.[A-Za-z0-9]{1,5})?$", "{n}$1"),
    (r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$", "{uuid}"),
    (r"^(?=.*[0-9])[0-9a-fA-F]{12,}$", "{hex}"),
    (r"^(.*[^0-9])?[0-9]{3,}(\.[A-Za-z0-9]{1,5})?$", "$1{n}$2"),
)
#: Share of URLs whose segment occurs once, from which a node's segments are variable (the chance that the
#: next URL brings a new one, after Good and Turing).
NEW = 0.5
#: Branches differ when such unlike labels, or more unlike ones, come about by chance less often than this.
CHANCE = 0.05
#: Labels up to which the test counts all cases; beyond, the normal distribution is as good.
EXACT = 2_000
#: Labels' worth of weight that the overall blocked share has in each template's purity.
PRIOR = 4.0


def url_host(url: Column) -> Column:
    """What stands after the first :// up to / ? # or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.coalesce(F.translate(host, upper, upper.lower()), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ? # or the end; empty without ://."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest rule that fits, as a struct (rule, verdict); null when none does.

    A rule is (verdict, "host/path"): it fits its host and all subdomains if the path starts with
    the rule's path. Rules are a short parameter; of equally long ones the first counts.
    """
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(reversed(rules), key=lambda r: len(r[1])):  # the longest is asked first
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def _shape(segment: Column) -> Column:
    """The segment, or its wildcard when its form is variable (the first form that fits)."""
    out = segment
    for pattern, wildcard in reversed(SHAPES):
        out = F.when(segment.rlike(pattern), F.regexp_replace(segment, pattern, wildcard)).otherwise(out)
    return out


def segments(path: Column) -> Column:
    """Path segments by form, all of them."""
    parts = F.transform(F.split(F.substr(path, F.lit(2)), "/"), _shape)
    return F.when(path == "", F.array().cast("array<string>")).otherwise(parts)


def chance(blocked: int, labelled: int, all_blocked: int, all_labelled: int) -> float:
    """Probability of shares as unlike as these between a part of the labels and the rest (two-sided, exact)."""
    rest, allowed = all_labelled - labelled, all_labelled - all_blocked
    if not labelled or not rest or not all_blocked or not allowed:
        return 1.0
    if all_labelled > EXACT:
        share = all_blocked / all_labelled
        error = math.sqrt(share * (1 - share) * (1 / labelled + 1 / rest))
        return math.erfc(abs(blocked / labelled - (all_blocked - blocked) / rest) / error / math.sqrt(2))

    def log_choose(n: int, k: int) -> float:
        return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)

    cases = range(max(0, labelled - allowed), min(labelled, all_blocked) + 1)
    logs = {k: log_choose(all_blocked, k) + log_choose(allowed, labelled - k) for k in cases}
    whole = log_choose(all_labelled, labelled)
    return min(1.0, sum(math.exp(x - whole) for x in logs.values() if x <= logs[blocked] + 1e-9))


def _chances(blocked: pd.Series, labelled: pd.Series, all_blocked: pd.Series, all_labelled: pd.Series) -> pd.Series:
    return pd.Series([chance(*map(int, r)) for r in zip(blocked, labelled, all_blocked, all_labelled)], dtype="float64")


def _branches(here: DataFrame, level: int) -> DataFrame:
    """(host, template, part, general): what each branch of the nodes at one level is called."""
    node = ["host", "template"]
    # what a branch looks like: how most of its paths go on (of equally many, the last by name)
    following = F.coalesce(F.get(F.col("parts"), F.lit(level)), F.lit(""))
    sums = [F.sum(c).alias(c) for c in ("urls", "blocked", "labelled")]
    forms = here.groupBy(*node, "part", following.alias("form")).agg(*sums)
    most = F.max(F.struct("urls", "form"))["form"].alias("form")
    branches = forms.groupBy(*node, "part").agg(*sums, most)
    kind = (
        F.when(F.col("labelled") == 0, "none").when(F.col("blocked") == 0, "allowed")
        .when(F.col("blocked") == F.col("labelled"), "blocked").otherwise("mixed")
    )
    branches = branches.withColumn("kind", kind)
    # siblings that go on alike and have the same kind of labels; of mixed ones those whose shares agree
    kin = [*node, "form", "kind"]
    pooled = branches.groupBy(*kin).agg(
        F.sum("blocked").alias("all_blocked"), F.sum("labelled").alias("all_labelled"), F.count("*").alias("kin")
    )
    branches = branches.join(pooled, kin)
    odds = F.pandas_udf(_chances, "double")("blocked", "labelled", "all_blocked", "all_labelled")
    agrees = (F.col("kind") != "mixed") | ((F.col("kin") > 1) & (odds >= CHANCE))
    branches = branches.withColumn("agrees", agrees)
    own_kind = F.when(F.col("kind") != "none", F.col("kind"))
    nodes = branches.groupBy(*node).agg(
        F.count("*").alias("children"), F.sum("urls").alias("below"), F.count_if(F.col("urls") == 1).alias("singles"),
        (F.count_distinct(own_kind) <= 1).alias("one_kind"), F.count_if(F.col("kind") == "mixed").alias("mixed"),
    )
    branches = branches.join(nodes, node)
    # one mixed branch may contradict itself below, so that its children have to tell
    variable = (F.col("children") > 1) & (F.col("singles") > NEW * F.col("below")) & F.col("one_kind") & (F.col("mixed") == 0)
    label = F.when(F.col("kind") == "none", "").otherwise(F.concat(F.lit(":"), "kind"))
    general = (
        F.when(F.col("part").startswith("{"), F.col("part"))
        .when(variable, "{*}")
        .when((F.col("kin") > 1) & F.col("agrees"), F.concat(F.lit("{~"), F.col("form"), label, F.lit("}")))
        .otherwise(F.col("part"))
    )
    return branches.select(*node, "part", general.alias("general"))


def grow(paths: DataFrame) -> DataFrame:
    """``paths`` (host, parts, urls, blocked, labelled) with ``template``: its generalised segments.

    There are as many levels as some paths of a host share segments and one more, each a written table.
    """
    node, columns = ["host", "template"], [*paths.columns, "template"]
    growing = paths.withColumn("template", F.array().cast("array<string>"))
    # one table for all levels, so that what reads it has one scan, not one for each level
    spark, finished = paths.sparkSession, scratch(paths.sparkSession, "templates-finished")
    held, level = None, 0
    while True:
        level += 1
        # a path alone in its node has nothing to merge with
        sizes = growing.groupBy(*node).agg(F.count("*").alias("paths"))
        counted = lookup_join(growing, sizes, node, "inner")
        over = (F.col("paths") == 1) | (F.size("parts") < level)
        rest = F.concat("template", F.slice("parts", level, F.greatest(F.size("parts"), F.lit(1))))
        done = counted.where(over).withColumn("template", rest).select(*columns)
        with shuffles_removed(spark):
            done.write.mode("append").option("compression", "none").parquet(finished)
        here = counted.where(~over).withColumn("part", F.element_at("parts", level))
        branches = Staged(_branches(here, level), "branches")
        grown = lookup_join(here, branches.df, [*node, "part"], "inner")
        grown = grown.withColumn("template", F.concat("template", F.array("general"))).select(*columns)
        following = Staged(grown, "templates")
        branches.drop()
        if held:
            held.drop()
        held, growing = following, following.df
        if growing.isEmpty():
            return spark.read.schema(growing.schema).parquet(finished)


def _purities(trees: DataFrame, overall: float) -> DataFrame:
    """(host, template, purity, evidence); a template without labels has the purity of the nearest node above with some."""
    sums = [F.sum("blocked").alias("blocked"), F.sum("labelled").alias("labelled")]
    templates = trees.groupBy("host", "template").agg(*sums)
    length = F.size("template")
    above = F.transform(F.sequence(F.lit(0), length), lambda n: F.slice("template", F.lit(1), n))
    nodes = templates.where("labelled > 0").select("host", F.explode(above).alias("node"), "blocked", "labelled")
    nodes = nodes.groupBy("host", "node").agg(*sums)
    bare = templates.where("labelled = 0").select("host", "template", F.explode(above).alias("node"))
    nearest = bare.join(nodes, ["host", "node"]).groupBy("host", "template").agg(
        F.max_by(F.struct("blocked", "labelled"), F.size("node")).alias("near")
    )
    own = F.when(F.col("labelled") > 0, F.struct("blocked", "labelled")).otherwise(F.col("near"))
    found = templates.join(nearest, ["host", "template"], "left").withColumn("own", own)
    blocked, labelled = (F.coalesce(F.col(f"own.{c}"), F.lit(0)) for c in ("blocked", "labelled"))
    purity = (blocked + PRIOR * overall) / (labelled + PRIOR)
    return found.select("host", "template", purity.alias("purity"), F.col("labelled").alias("evidence"))


def judge(
    pages: DataFrame,
    rules: list[tuple[str, str]],
    id_column: str = "page_id",
    url_column: str = "url",
    label_column: str | None = None,
    reject: float = 0.5,
) -> DataFrame:
    """One row (id, host, path, rule, template, purity, verdict) per row of ``pages``.

    A rule's verdict counts where one fits. All other URLs get "block" when the smoothed blocked
    share of their template's labels reaches ``reject``, else "allow"; a template without labels
    is never rejected. Labels are the verdicts of
    the rules, or ``label_column`` (1: block, 0: allow, null: none). Null URLs and those without
    :// have an empty host and path and are a template of their own; repeated rows count each
    time, an empty table gives an empty one, paths of any depth are taken whole; without any label
    everything is allowed. Other columns are not read.
    """
    url = pages[url_column]
    label = pages[label_column] if label_column else F.lit(None).cast("int")
    rows = pages.select(
        pages[id_column].alias("id"), url_host(url).alias("host"), url_path(url).alias("path"),
        label.cast("int").alias("label"),
    )
    rows = rows.withColumn("found", rule_of(F.col("host"), F.col("path"), rules))
    if not label_column:
        rows = rows.withColumn("label", (F.col("found.verdict") == "block").cast("int"))
    rows = rows.withColumn("parts", segments(F.col("path")))
    paths = rows.groupBy("host", "parts").agg(
        F.count("*").alias("urls"),
        F.coalesce(F.sum("label"), F.lit(0)).alias("blocked"),
        F.count("label").alias("labelled"),
    )
    trees = grow(Staged(paths, "paths").df)
    totals = trees.agg(F.sum("blocked"), F.sum("labelled")).first()
    overall = (totals[0] or 0) / totals[1] if totals[1] else 0.0
    purities = Staged(_purities(trees, overall), "purities").df
    verdicts = trees.join(purities, ["host", "template"]).select(
        "host", "parts", F.concat(F.lit("/"), F.array_join("template", "/")).alias("template"), "purity", "evidence"
    )
    # one page may hold a third of all rows; both sides come from the same rows, without nulls
    rows = lookup_join(rows, verdicts, ["host", "parts"], "left")
    learned = F.when((F.col("evidence") > 0) & (F.col("purity") >= reject), "block").otherwise("allow")
    return rows.select(
        "id", "host", "path", F.col("found.rule").alias("rule"), "template", "purity",
        F.coalesce("found.verdict", learned).alias("verdict"),
    )
