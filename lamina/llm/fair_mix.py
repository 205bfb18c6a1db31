"""Mixing sources to target weights by weighted fair queueing, in DataFrame operations only.

Every source queues its documents in a keyed random order, as often as ``max_epochs`` allows.
A document's virtual finish time is its source's words so far divided by the source's target.
All queued documents are sorted by finish time and cut where the words reach the budget.

No window covers a source or the whole table: words are summed per (source, slice of the
order), then per slice of finish times, and only these bounded sums are accumulated before
each row adds the rows of its own slice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lamina.llm.common import Staged

#: Slices of a source's order (hex digits), slices of a unit of finish time, and of its doublings
#: beyond 2. They only say how the work is split; results do not depend on them.
SLICE_DIGITS, UNIT_SLICES, DOUBLING_SLICES = 3, 2048, 64
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text) -> Column:
    """Words of a text; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(sizes: DataFrame, weights: list[float], share: float, cap: float) -> DataFrame:
    """(source, source_size, target): words each source should give.

    ``sizes`` holds (source, source_size). Sources by code point, null last, take ``weights`` in
    turn and share ``share`` times all words; a target stops at ``cap`` times its source's size
    and what is over is shared again by weight. The level at which nobody is above its cap is
    found directly: sources are filled in the order of cap divided by weight.
    """
    turn = F.row_number().over(W.orderBy(F.col("source").isNull(), F.col("source"))) - 1
    table = F.array(*[F.lit(float(w)) for w in weights])
    rows = sizes.withColumn("weight", F.element_at(table, (turn % len(weights) + 1).cast("int")))
    rows = rows.withColumn("cap", F.lit(float(cap)) * F.col("source_size"))
    everything, order = W.partitionBy(), W.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    rows = rows.withColumn("budget", F.lit(float(share)) * F.sum("source_size").over(everything))
    before = order.rowsBetween(W.unboundedPreceding, -1)
    rest = order.rowsBetween(0, W.unboundedFollowing)
    rows = rows.withColumn(
        "level",
        (F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(rest),
    )
    fits = F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.col("level"))
    rows = rows.withColumn("level", F.max(fits).over(everything))
    filled = F.least("cap", F.col("level") * F.col("weight"))
    return rows.select("source", "source_size", F.coalesce(filled, F.col("cap")).alias("target"))


def queue_key(id_column, text, seed: str) -> Column:
    """32 hex digits that order a source's documents; a null id is replaced by the text."""
    own = F.coalesce(id_column.cast("string"), F.concat(F.lit("~"), F.coalesce(text, F.lit(""))))
    return F.md5(F.concat(F.lit(f"{seed}:"), own))


def mix(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    weights: list[float] = (5.0, 2.0, 1.0),
    share: float = 1.5,
    max_epochs: int = 2,
    seed: str = "mix",
) -> DataFrame:
    """One row per row of ``docs``: id, source, size, source_size, target, copies, taken.

    ``copies`` says how often the mix takes the document (0 to ``max_epochs``), ``taken`` its
    words in the mix. Null texts have no words, a null source is a source of its own, repeated
    rows are documents of their own (equal rows may get different copies; as a set of rows the
    result is the same in every run). An empty table, or one without any word, takes nothing.
    """
    text = docs[text_column]
    rows = docs.select(
        docs[id_column].alias("id"),
        docs[source_column].alias("source"),
        word_count(text).alias("size"),
        queue_key(docs[id_column], text, seed).alias("key"),
    ).withColumn("slice", F.left("key", F.lit(SLICE_DIGITS)))
    rows = Staged(rows, "mix").df
    slices = rows.groupBy("source", "slice").agg(F.sum("size").alias("words"))
    aims = targets(slices.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share, max_epochs)
    ahead = W.partitionBy("source").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    starts = (
        slices.withColumn("start", F.coalesce(F.sum("words").over(ahead), F.lit(0)))
        .join(aims.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
        .select(F.col("s"), F.col("slice").alias("sl"), "start", "source_size", "target")
    )
    within = W.partitionBy("source", "slice").orderBy("key", "id", "size").rowsBetween(W.unboundedPreceding, 0)
    queued = rows.withColumn("run", F.sum("size").over(within)).join(
        starts, F.col("source").eqNullSafe(F.col("s")) & (F.col("slice") == F.col("sl"))
    )
    # the words of the source up to and with this row, in the first epoch
    queued = queued.withColumn("through", F.col("start") + F.col("run"))
    parts = [_finish(e) for e in range(max_epochs)]
    queued = queued.withColumn("times", F.when(F.col("target") > 0, F.array(*[_slice(p) for p in parts])))
    queued = Staged(queued.select(*_ROW, "through", "times"), "mix", light=True).df
    # where the budget ends: sums per slice of finish times are few, and the result is one row
    spent = queued.select("size", F.explode("times").alias("time")).groupBy("time").agg(F.sum("size").alias("words"))
    spent = spent.withColumn("until", F.sum("words").over(W.orderBy("time")))
    budget = F.lit(float(min(share, max_epochs))) * F.col("all_words")
    spent = spent.withColumn("all_words", F.lit(rows.agg(F.sum("size")).first()[0] or 0))
    edge, before, limit = spent.agg(
        F.min(F.when(F.col("until") > budget, F.col("time"))),
        F.coalesce(F.max(F.when(F.col("until") <= budget, F.col("until"))), F.lit(0)),
        F.max(budget),
    ).first()
    times = F.coalesce("times", F.array().cast("array<bigint>"))
    if edge is None:
        return _taken(queued.withColumn("copies", F.size(times)))
    edge = F.lit(edge)
    queued = queued.withColumn("copies", F.size(F.filter(times, lambda t: t < edge)))
    at_edge = F.coalesce(F.array_contains("times", edge), F.lit(False))
    # rows with a queued copy in the slice where the budget ends are looked at one by one;
    # only rows without words can agree in all these columns, and those are decided together
    busy = queued.where(at_edge).groupBy(*_ROW, "through", "copies").agg(F.count("*").alias("rows"))
    items = busy.select("*", F.explode(F.array(*[F.struct(F.lit(e).alias("epoch"), p.alias("finish")) for e, p in enumerate(parts)])).alias("item"))
    items = items.where(_slice(F.col("item.finish")) == edge)
    order = W.partitionBy(F.lit(0)).orderBy(
        "item.finish", "item.epoch", F.col("source").isNull(), "source", "key", "id", "size"
    )
    until = F.sum(F.col("size") * F.col("rows")).over(order.rowsBetween(W.unboundedPreceding, 0))
    items = items.withColumn("fits", (F.lit(before) + until <= F.lit(limit)).cast("int"))
    busy = items.groupBy(*_ROW, "through", "copies", "rows").agg(F.sum("fits").alias("more"))
    busy = busy.withColumn("copies", (F.col("copies") + F.col("more")).cast("int"))
    busy = busy.withColumn("row", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("rows"))))
    calm = queued.where(~at_edge)
    return _taken(calm.select(*_ROW, "copies").unionByName(busy.select(*_ROW, "copies")))


_ROW = ("id", "source", "size", "key", "source_size", "target")


def _finish(epoch: int) -> Column:
    return (F.col("through") + F.lit(epoch) * F.col("source_size")).cast("double") / F.col("target")


def _slice(finish: Column) -> Column:
    beyond = 2 * UNIT_SLICES + F.floor((F.log2(finish) - 1) * DOUBLING_SLICES)
    return F.when(finish < 2, F.floor(finish * UNIT_SLICES)).otherwise(beyond)


def _taken(rows: DataFrame) -> DataFrame:
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return rows.select("id", "source", "size", "source_size", "target", "copies", taken, "key")


def materialise(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                source_column: str = "source", seed: str = "mix", **options) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as the mix takes it, in the columns of ``docs``.

    Rows that agree in id, source and number of words share their copies in the order of the text.
    """
    many = mix(docs, id_column, text_column, source_column, seed=seed, **options)
    shares = many.groupBy(
        F.col("source").alias("__s"), F.col("key").alias("__k"), F.col("size").alias("__n"), "copies"
    ).agg(F.count("*").alias("rows"))
    shares = shares.groupBy("__s", "__k", "__n").agg(
        F.sort_array(F.collect_list(F.struct("copies", "rows")), asc=False).alias("__shares")
    )
    text = docs[text_column]
    rows = docs.select("*", word_count(text).alias("__size"), queue_key(docs[id_column], text, seed).alias("__key"))
    same = F.col(source_column).eqNullSafe(F.col("__s")) & (F.col("__key") == F.col("__k"))
    rows = rows.join(shares, same & (F.col("__size") == F.col("__n")))
    turn = F.row_number().over(W.partitionBy("__s", "__k", "__n").orderBy(text_column))
    # shares are few (one per number of copies): take the first whose rows reach this turn
    reached = F.aggregate(
        "__shares",
        F.struct(F.lit(0).cast("bigint").alias("rows"), F.lit(-1).alias("copies")),
        lambda a, x: F.struct(
            (a["rows"] + x["rows"]).alias("rows"),
            F.when((a["copies"] < 0) & (a["rows"] + x["rows"] >= F.col("__turn")), x["copies"]).otherwise(a["copies"]).alias("copies"),
        ),
    )
    rows = rows.withColumn("__turn", turn).withColumn("__copies", reached["copies"]).where("__copies > 0")
    return rows.withColumn("__copy", F.explode(F.sequence(F.lit(1), "__copies"))).select(*docs.columns)
