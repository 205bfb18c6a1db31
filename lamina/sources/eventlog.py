"""Event logs: bounded replay from offsets, offset checkpoints, message envelopes.

The shape is that of a message broker: (topic, partition, offset, timestamp, key,
value, headers). ``broker_options`` names the options for Spark's own broker source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

LOG_SCHEMA = (
    "topic string, partition int, offset bigint, timestamp string, key string,"
    " value string, headers map<string,string>"
)
TOPIC = ["topic", "partition"]
# Offsets per counted block; see first_messages.
BLOCK = 1 << 20


def read_log(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """JSON-lines log; blank lines are skipped, a broken line is an error, no offset means -1."""
    log = spark.read.schema(LOG_SCHEMA).option("mode", "FAILFAST").json(paths)
    return log.withColumn("offset", F.coalesce("offset", F.lit(-1)))


def start_offset(checkpoint: int | None, configured: int | None, earliest: bool = False) -> int:
    if earliest:
        return 0
    return next((x for x in (checkpoint, configured) if x is not None), 0)


def from_offsets(log: DataFrame, starts: DataFrame | None = None, default: int = 0) -> DataFrame:
    """Messages at or after the start of their topic partition.

    ``starts`` holds (topic, partition, start_offset); a partition it lacks starts at
    ``default``.
    """
    if starts is None:
        return log.filter(F.col("offset") >= default)
    known = starts.select(*TOPIC, F.col("start_offset").alias("__start"))
    joined = log.join(known, TOPIC, "left")
    keep = F.col("offset") >= F.coalesce("__start", F.lit(default))
    return joined.filter(keep).select(*log.columns)


def first_messages(log: DataFrame, max_messages: int, width: int = BLOCK) -> DataFrame:
    """The first ``max_messages`` by offset of every topic partition.

    The log is counted in blocks of ``width`` offsets: blocks before the cap are taken whole
    and only the block that crosses it is ranked, so no task sorts a whole topic. A null topic
    or partition is one like any other; a null offset counts as -1.
    """
    offset = F.coalesce("offset", F.lit(-1))
    keyed = log.withColumn("__block", F.floor(offset / width))
    counts = keyed.groupBy(*TOPIC, "__block").agg(F.count(F.lit(1)).alias("n"))
    running = W.partitionBy(*TOPIC).orderBy("__block").rowsBetween(W.unboundedPreceding, -1)
    counts = counts.withColumn("__before", F.coalesce(F.sum("n").over(running), F.lit(0)))
    wanted = counts.filter(F.col("__before") < max_messages).select(
        *[F.col(c).alias(f"__{c}") for c in TOPIC], F.col("__block").alias("__wanted"),
        F.least(F.lit(max_messages) - F.col("__before"), F.col("n")).alias("__take"), F.col("n").alias("__n"),
    )
    match = F.col("__block") == F.col("__wanted")
    for c in TOPIC:
        match = match & F.col(c).eqNullSafe(F.col(f"__{c}"))
    rows = keyed.join(wanted, match)
    crossing = F.col("__take") < F.col("__n")
    ranked = W.partitionBy(*TOPIC, "__block").orderBy(offset)
    cut = rows.filter(crossing).withColumn("__rank", F.row_number().over(ranked))
    cut = cut.filter(F.col("__rank") <= F.col("__take"))
    return rows.filter(~crossing).select(*log.columns).unionByName(cut.select(*log.columns))


def offsets_after(pulled: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """(topic, partition, next_offset): highest offset plus one; unchanged without messages."""
    fresh = pulled.groupBy(*TOPIC).agg((F.max("offset") + 1).alias("next_offset"))
    if before is None:
        return fresh
    old = before.select(*TOPIC, F.col("next_offset").alias("__old"))
    joined = fresh.join(old, TOPIC, "full_outer")
    return joined.select(*TOPIC, F.coalesce("next_offset", "__old").alias("next_offset"))


def encode(log: DataFrame) -> DataFrame:
    """One JSON text per message; binary keys and values become valid UTF-8."""
    fields = []
    for f in log.schema.fields:
        value = F.col(f.name)
        if f.dataType.simpleString() == "binary":
            value = F.make_valid_utf8(value.cast("string"))
        fields.append(value.alias(f.name))
    body = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    return log.select(body.alias("payload"))


def decode(payloads: DataFrame, schema: str = LOG_SCHEMA) -> DataFrame:
    return payloads.select(F.from_json("payload", schema).alias("m")).select("m.*")


def broker_options(
    servers: str, topic: str, starts: str = "earliest", ends: str | None = None,
    max_offsets: int | None = None,
) -> dict[str, str]:
    """Options for ``spark.read.format("kafka")`` (needs the connector on the class path)."""
    out = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starts,
           "includeHeaders": "true"}
    if ends is not None:
        out["endingOffsets"] = ends
    if max_offsets is not None:
        out["maxOffsetsPerTrigger"] = str(max_offsets)
    return out
