"""Large JSON documents, read by many tasks: a file with an array at its root gives its elements.

Spark's text reader splits a file into ranges and hands on what lies between closing braces. What a
brace or comma means depends on all bytes before it, so the ranges are read twice. The first pass
condenses each range for both cases, that it begins inside or outside a string: quotes, change of
depth, and commas by depth. Sums over the ranges of a file then say how each range begins. The
second pass cuts the ranges at the commas of the root array; elements that lie in several ranges
are put together by their number. No value is larger than an element and the bytes to its first brace.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.session import staged

ARTIFACT = "_artifact"
POSITION = "_position"

# the executors need not have this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BRACE, QUOTE, BACKSLASH, COMMA = b"}", ord('"'), ord("\\"), ord(",")
OPENING, CLOSING = (ord("{"), ord("[")), (ord("}"), ord("]"))
BLANK = b" \t\r\n"

#: Tasks for each core that a scan in ranges of a given size has at most, about.
TASKS_A_CORE = 16

#: Whether a byte is a bracket or a comma, and how it changes the depth.
STEP = np.zeros(256, dtype=np.int64)
STEP[list(OPENING)], STEP[list(CLOSING)] = 1, -1
STRUCTURE = STEP != 0
STRUCTURE[COMMA] = True


def _marks(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the quotes that begin or end strings, and of brackets and commas.

    ``raw`` begins at a place that no backslash escapes.
    """
    quotes = np.flatnonzero(raw == QUOTE)
    if (raw == BACKSLASH).any():
        # an odd number of backslashes before a quote makes it part of the string
        places = np.arange(len(raw))
        last_other = np.maximum.accumulate(np.where(raw != BACKSLASH, places, -1))
        before = quotes - 1
        run = np.where(before >= 0, before - last_other[before], 0)
        quotes = quotes[run % 2 == 0]
    return quotes, np.flatnonzero(STRUCTURE[raw])


def _condensed(raw: np.ndarray) -> tuple[int, list[tuple[int, dict[int, int]]]]:
    """Quotes of a stretch, and for a start outside and inside a string its change of depth and commas.

    Commas are counted by their depth relative to the start.
    """
    quotes, other = _marks(raw)
    inside = np.searchsorted(quotes, other) % 2
    cases = []
    for case in (0, 1):
        places = other[inside == case]
        steps = STEP[raw[places]]
        depths = np.cumsum(steps)
        levels, counts = np.unique(depths[steps == 0], return_counts=True)
        cases.append((int(steps.sum()), dict(zip(levels.tolist(), counts.tolist()))))
    return len(quotes), cases


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, bytes]]:
    """((file, start of range, further columns), bytes) for the rows of each range in each batch."""
    for batch in batches:
        if not batch.num_rows:
            continue
        # keys become Python objects once a stretch, not once a row
        new = np.zeros(batch.num_rows, dtype=bool)
        new[0] = True
        for column in (batch.column(1), batch.column(2)):
            new[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(new).tolist()
        texts = batch.column(0).fill_null(b"")
        for at, end in zip(starts, [*starts[1:], batch.num_rows]):
            key = tuple(batch.column(n)[at].as_py() for n in range(1, batch.num_columns))
            # values ended at a brace, which the reader took away; perhaps not the last of the file
            yield key, BRACE.join([*texts.slice(at, end - at).to_pylist(), b""])


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each range: what the sums over the file need."""
    key, held = None, None

    def row() -> pa.RecordBatch:
        columns = [[key[0]], [key[1]], [key[2]], [held["bytes"]], [held["quotes"] % 2], [held["head"]]]
        for case in (0, 1):
            columns += [[held["depth"][case]], [list(held["commas"][case].items())]]
        kinds = [pa.string(), *[pa.int64()] * 4, pa.string()] + [pa.int64(), pa.map_(pa.int64(), pa.int64())] * 2
        names = ["file", "start", "size", "bytes", "quotes", "head", "depth0", "commas0", "depth1", "commas1"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    for found, raw in _stretches(batches):
        if found != key:
            if key:
                yield row()
            key, held = found, {"bytes": 0, "quotes": 0, "head": "", "depth": [0, 0], "commas": [{}, {}]}
        held["bytes"] += len(raw)
        if not held["head"]:
            held["head"] = raw.removeprefix(b"\xef\xbb\xbf").lstrip(BLANK)[:1].decode("latin-1")
        quotes, cases = _condensed(np.frombuffer(raw, dtype=np.uint8))
        for start in (0, 1):
            # the stretch begins as the quotes since the start of the range say
            depth, commas = cases[(start + held["quotes"]) % 2]
            for level, count in commas.items():
                level += held["depth"][start]
                held["commas"][start][level] = held["commas"][start].get(level, 0) + count
            held["depth"][start] += depth
        held["quotes"] += quotes
    if key:
        yield row()


ELEMENTS = "file string, position bigint, start bigint, part int, text binary"


def _elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Elements that lie in one range, and the parts of the others at the borders of the range.

    Rows have the element's number, the start of the range, and 0 for whole elements, else 1 for what
    begins the range and 2 for what ends it.
    """
    key = state = final = extra = None

    def emit(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
        names = ["file", "position", "start", "part", "text"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    def last() -> tuple:
        return (key[0], state["number"], key[1], state["part"], b"".join(state["held"]))

    def ended() -> tuple:
        if final and not state["closed"]:
            raise ValueError(f"{key[0]}: the document has no end")
        return last()

    for found, raw in _stretches(batches):
        rows = []
        if found != key:
            if key:
                rows.append(ended())
            key = found
            _, _, quoted, depth, commas, root, first, final, left, extra = key
            state = {"quoted": quoted, "depth": depth, "number": commas, "part": 1, "held": [], "left": left,
                     "array": root == "[", "opened": not first, "closed": root == "" or depth == 0 and not first}
        state["left"] -= len(raw)
        if extra and not state["left"]:
            raw = raw[:-1]
        data = np.frombuffer(raw, dtype=np.uint8)
        quotes, other = _marks(data)
        places = other[(np.searchsorted(quotes, other) + state["quoted"]) % 2 == 0]
        steps = STEP[data[places]]
        depths = state["depth"] + np.cumsum(steps)
        state["quoted"] = (state["quoted"] + len(quotes)) % 2
        begin, end = 0, len(raw)
        if not state["opened"] and not state["closed"]:
            # the root opens: an array's bracket is no part of an element
            state["opened"] = True
            begin = int(places[0]) + 1 if state["array"] else 0
        closes = np.flatnonzero((depths == 0) & (steps < 0))
        rest = raw
        if not state["closed"]:
            rest = b""
            if len(closes):
                place = int(places[closes[0]])
                end, rest = (place if state["array"] else place + 1), raw[place + 1 :]
            if state["array"]:
                for place in places[(steps == 0) & (depths == 1) & (places < end)].tolist():
                    state["held"].append(raw[begin:place])
                    rows.append(last() if state["part"] == 1 else (key[0], state["number"], key[1], 0, b"".join(state["held"])))
                    begin = place + 1
                    state.update(number=state["number"] + 1, part=2, held=[])
            state["held"].append(raw[begin:end])
            state["closed"] = bool(len(closes))
        if rest.strip(BLANK):
            raise ValueError(f"{key[0]}: text after the end of the document")
        state["depth"] = int(depths[-1]) if len(depths) else state["depth"]
        if rows:
            yield emit(rows)
    if key:
        yield emit([ended()])


def _file_rows(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    text = spark.read.option("lineSep", BRACE.decode()).text(paths)
    return text.select(
        F.col("value").cast("binary").alias("value"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("_metadata.file_size").alias("size"),
    )


def _starts(summaries: DataFrame) -> DataFrame:
    """How each range begins: inside a string (1) or not, its depth, and the elements before it."""
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    def so_far(column: Column | str) -> Column:
        return F.coalesce(F.sum(column).over(before), F.lit(0))

    def case(name: str) -> Column:
        return F.when(F.col("quoted") == 0, F.col(f"{name}0")).otherwise(F.col(f"{name}1"))

    known = summaries.withColumn("quoted", so_far("quotes") % 2)
    known = known.withColumn("depth", so_far(case("depth")))
    commas = F.coalesce(F.try_element_at(case("commas"), 1 - F.col("depth")), F.lit(0).cast("bigint"))
    known = known.withColumn("commas", so_far(commas))
    # the first range holds all up to the first brace, and so the first character that is not blank
    first, final = F.col("start") == F.min("start").over(whole), F.col("start") == F.max("start").over(whole)
    # the last brace was not in the file if there are more bytes than in it; a byte-order mark (3) is not read
    surplus = F.sum("bytes").over(whole) - F.col("size")
    added = surplus.isin(1, -2)
    alone = (F.first("head").over(whole) == BRACE.decode()) & added & (F.count("*").over(whole) == 1)
    return known.select(
        "file", "start", "quoted", "depth", "commas", F.when(alone, "").otherwise(F.first("head").over(whole)).alias("root"),
        first.alias("first"), final.alias("final"), "bytes", (final & added).alias("extra"),
    )


def scan_json_ranges(
    spark: SparkSession,
    paths: str | list[str],
    schema: T.StructType | None = None,
    range_bytes: int | None = None,
) -> DataFrame:
    """JSON documents, one per file, each read by as many tasks as it has ranges.

    An array at the root gives one row per element, another root one row. Rows have the file's path and the
    element's position. Files are UTF-8, a byte-order mark is skipped; a blank file or an empty array gives no
    row, a null element a row of nulls. Broken JSON and text after the document are errors.
    ``range_bytes`` is the size of a range for this scan (by default the session's for files). The elements are
    written to the shared folder once; without a schema they are read once more to infer it.
    """
    conf, name, most = spark.conf, "spark.sql.files.maxPartitionBytes", "spark.sql.files.maxPartitionNum"
    usual, usual_most = conf.get(name), conf.get(most, None)
    try:
        if range_bytes:
            conf.set(name, str(range_bytes))
            # small ranges share tasks, which cost more than they
            conf.set(most, str(TASKS_A_CORE * spark.sparkContext.defaultParallelism))
        kinds = "file string, start bigint, size bigint, bytes bigint, quotes bigint, head string"
        kinds += "".join(f", depth{n} bigint, commas{n} map<bigint,bigint>" for n in (0, 1))
        rows = _file_rows(spark, paths)
        starts = staged(_starts(staged(rows.mapInArrow(_summaries, kinds), "json-ranges")), "json-starts")
        # one row for each range of a file; a join that moves the rows would lose their order
        placed = rows.drop("size").join(F.broadcast(starts), ["file", "start"])
        placed = placed.select("value", *starts.columns)
        parts = staged(placed.mapInArrow(_elements, ELEMENTS), "json-elements")
    finally:
        conf.set(name, usual)
        if usual_most is None:
            conf.unset(most)
        else:
            conf.set(most, usual_most)
    whole = parts.where("part = 0").select("file", "position", "text")
    split = parts.where("part > 0").groupBy("file", "position").agg(
        F.array_sort(F.collect_list(F.struct("start", "part", "text"))).alias("parts")
    )
    # parts begin and end at braces and commas, so that no character is cut
    joined = F.array_join(F.transform("parts", lambda part: F.decode(part["text"], "UTF-8")), "")
    found = whole.withColumn("text", F.decode("text", "UTF-8"))
    found = found.unionByName(split.select("file", "position", joined.alias("text")))
    found = found.withColumn("text", F.trim(F.regexp_replace("text", "^\ufeff", ""), F.lit(" \t\r\n")))
    found = found.where("text <> ''")
    if schema is None:
        texts = getattr(found.select("text")._jdf, "as")(spark._jvm.org.apache.spark.sql.Encoders.STRING())
        schema = T.StructType.fromJson(json.loads(spark._jsparkSession.read().json(texts).schema().json()))
    doc = F.when(F.col("text") != "null", F.from_json("text", schema, {"mode": "FAILFAST"})).alias("doc")
    rows = found.select(F.col("file").alias(ARTIFACT), F.col("position").cast("int").alias(POSITION), doc)
    return rows.select(ARTIFACT, POSITION, "doc.*")
