"""Training-order materialisation: packed sequences of token ids in fixed-stride binary shards.

Documents are laid end to end, an end token after each, and cut into sequences of one length.
Every sequence has a number from 0 to N - 1; a keyed Feistel permutation, walked until it falls
below N again, gives each a slot of its own without sorting or a shuffled list. Shard s holds
slots s * R to (s + 1) * R - 1 in order, each record has the same length, so record k of a run
stands at a known byte of a known file and a stopped run goes on there. A table beside the shards
says which documents a slot's tokens come from.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lamina import storage
from lamina.llm.common import Staged, shuffles_removed, slices

#: A record: the number of tokens used, then the tokens.
HEADER = np.dtype([("used", "<u4")])
#: Each record ends with this byte; it is the writer's line separator.
END = b"\n"
#: Where a sequence's tokens come from: document, first place in the sequence, first token of the document.
SEGMENTS = "array<struct<id:bigint,start:int,offset:bigint>>"
ROUNDS = 6
#: Files that the encoded records are first written to, at most: bounds the table of their offsets.
MOST_FILES = 16_384
#: Shards are written in so many turns; the shuffle files of one turn are on disk at a time.
WAVES = 2


def stride(length: int) -> int:
    return HEADER.itemsize + 2 * length + len(END)


def _mix(x: np.ndarray) -> np.ndarray:
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def permute(numbers: np.ndarray, size: int, key: int) -> np.ndarray:
    """Slots of ``numbers`` under a keyed permutation of 0 .. ``size`` - 1 (a bijection)."""
    half = np.uint64(max(1, (max(1, size - 1).bit_length() + 1) // 2))
    mask = (np.uint64(1) << half) - np.uint64(1)
    keys = _mix(np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(key & (1 << 63) - 1))
    out = numbers.astype(np.uint64)
    walking = np.arange(len(out))
    while len(walking):
        left, right = out[walking] >> half, out[walking] & mask
        for k in keys:
            left, right = right, left ^ (_mix(right ^ k) & mask)
        out[walking] = (left << half) | right
        walking = walking[out[walking] >= np.uint64(size)]
    return out.astype(np.int64)


class _Packer:
    """Fills sequences one after the other from the documents of a task."""

    def __init__(self, length: int, end: int, pad: int):
        self.length, self.end, self.pad = length, end, pad
        self.row = np.empty(1, dtype=[*HEADER.descr, ("tokens", "<u2", (length,))])
        self.used, self.segments = 0, []
        self.done: list[tuple[bytes, list[dict]]] = []

    def add(self, key: int | None, ids: np.ndarray) -> None:
        if len(ids) and (ids.min() < 0 or ids.max() > 65535):
            raise ValueError("token ids have to fit in 16 bits")
        ids, at = np.append(ids, self.end), 0
        while at < len(ids):
            take = min(self.length - self.used, len(ids) - at)
            self.row["tokens"][0, self.used : self.used + take] = ids[at : at + take]
            self.segments.append({"id": key, "start": self.used, "offset": at})
            self.used, at = self.used + take, at + take
            if self.used == self.length:
                self.close()

    def close(self) -> None:
        if self.used:
            self.row["used"] = self.used
            self.row["tokens"][0, self.used :] = self.pad
            self.done.append((self.row.tobytes(), self.segments))
            self.used, self.segments = 0, []

    def batch(self) -> pa.RecordBatch:
        kind = pa.list_(pa.struct([("id", pa.int64()), ("start", pa.int32()), ("offset", pa.int64())]))
        records, segments = [d[0] for d in self.done], [d[1] for d in self.done]
        self.done = []
        return pa.RecordBatch.from_arrays(
            [pa.array(records, pa.binary()), pa.array(segments, kind)], ["record", "segments"]
        )


def _packed(rows: DataFrame, length: int, end: int, pad: int, to_ids: Callable) -> DataFrame:
    """(record, segments) of two columns: an id, and what ``to_ids()`` turns into token ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, ids_of = _Packer(length, end, pad), to_ids()
        for part in (p for batch in batches for p in slices(batch, 1)):
            for key, value in zip(part.column(0).to_pylist(), part.column(1)):
                packer.add(key, ids_of(value))
            yield packer.batch()
        packer.close()
        yield packer.batch()

    return rows.mapInArrow(run, f"record binary, segments {SEGMENTS}")


def pack(tokens: DataFrame, id_column: str, ids_column: str, length: int, end: int, pad: int) -> DataFrame:
    """(record, segments): the rows' ids in sequences of ``length``, ``end`` after each row.

    A row without ids (null or empty) is an end token alone; a null id stays null in the segments.
    Each task's last sequence is filled with ``pad``. Ids have to fit in 16 bits.
    """

    def to_ids():
        return lambda value: value.values.to_numpy() if value.is_valid else np.empty(0, np.int32)

    rows = tokens.select(tokens[id_column].cast("bigint"), tokens[ids_column].cast("array<int>"))
    return _packed(rows, length, end, pad, to_ids)


@lru_cache(maxsize=2)
def _encoding(ranks_path: str, pattern: str):
    # imported where texts are tokenised: the other functions take ids from anywhere
    import tiktoken

    from lamina.llm.byte_bpe import load_ranks

    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=load_ranks(ranks_path), special_tokens={})


def pack_texts(
    docs: DataFrame, id_column: str, text_column: str, ranks_path: str, pattern: str, length: int, end: int, pad: int
) -> DataFrame:
    """As ``pack``, of texts that the same tasks tokenise with the library of the rank file."""

    def to_ids():
        encode = _encoding(ranks_path, pattern).encode_ordinary
        return lambda value: np.array(encode(value.as_py() or ""), dtype=np.int32)

    rows = docs.select(docs[id_column].cast("bigint"), docs[text_column])
    return _packed(rows, length, end, pad, to_ids)


def write(records: DataFrame, path: str, per_shard: int, key: int) -> int:
    """Write records to ``path``/shards/shard=s, slot by slot; returns their number.

    Numbers follow the files of a table written first; slots only depend on the numbers, the
    number of records and ``key``. Each task writes one range of slots, a shard; ``path``/shards may not exist.
    ``path``/segments has (slot, segments).
    """
    if storage.exists(records.sparkSession, f"{path}/shards"):
        raise FileExistsError(f"{path}/shards")
    table = Staged(records.coalesce(MOST_FILES), "sequences", "zstd")
    places = table.df.select("record", "segments", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))
    counts = places.groupBy("file").agg(F.count("*").alias("n"))
    size = counts.agg(F.sum("n")).first()[0]
    if not size:
        nothing = places.select(F.col("row").alias("slot"), "segments")
        nothing.write.mode("errorifexists").parquet(f"{path}/segments")
        return 0
    before = W.orderBy("file").rowsBetween(W.unboundedPreceding, -1)
    first = counts.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))

    @F.pandas_udf("bigint")
    def slot_of(number: pd.Series) -> pd.Series:
        return pd.Series(permute(number.to_numpy(), size, key))

    # a row per file, of which there are MOST_FILES at most
    slots = places.join(F.broadcast(first), "file").withColumn("slot", slot_of(F.col("start") + F.col("row")))
    slots.select("slot", "segments").write.mode("errorifexists").parquet(f"{path}/segments")
    slots = slots.withColumn("shard", F.expr(f"slot div {per_shard}"))
    shards = -(-size // per_shard)
    wave = -(-shards // WAVES)
    for begin in range(0, shards, wave):
        # part p of a wave holds one range of slots, its shard number ``begin`` + p
        part = slots.where((F.col("shard") >= begin) & (F.col("shard") < begin + wave))
        part = part.repartitionById(min(wave, shards - begin), (F.col("shard") - begin).cast("int"))
        # bytes pass through the text writer unchanged
        out = part.sortWithinPartitions("shard", "slot").select(F.col("record").cast("string").alias("value"), "shard")
        with shuffles_removed(table.spark):
            out.write.partitionBy("shard").option("lineSep", END.decode()).mode("append").text(f"{path}/shards")
    table.drop()
    return size


def read(spark: SparkSession, path: str, length: int, per_shard: int, start: int = 0, stop: int | None = None) -> DataFrame:
    """(slot, shard, tokens) of slots ``start`` to ``stop``; only their shards are opened.

    A shard whose size is no multiple of the stride is an error. Without shards there are no rows.
    """
    if not storage.has_files(spark, f"{path}/shards"):
        return spark.createDataFrame([], "slot bigint, shard bigint, tokens array<int>")
    kind = np.dtype([*HEADER.descr, ("tokens", "<u2", (length,)), ("end", "u1")])
    files = spark.read.format("binaryFile").load(f"{path}/shards").where(F.col("shard") >= start // per_shard)
    if stop is not None:
        files = files.where(F.col("shard") < -(-stop // per_shard))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows = np.frombuffer(content.as_buffer(), dtype=kind)
                slots = shard * per_shard + np.arange(len(rows))
                inside = (slots >= start) & (slots < (slots[-1] + 1 if stop is None else stop))
                rows, slots = rows[inside], slots[inside]
                used = rows["used"].astype(np.int64)
                tokens = rows["tokens"][np.arange(length)[None, :] < used[:, None]]
                ends = pa.array(np.concatenate([[0], np.cumsum(used)]), pa.int32())
                lists = pa.ListArray.from_arrays(ends, pa.array(tokens, pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(slots), pa.array(np.full(len(rows), shard)), lists], ["slot", "shard", "tokens"]
                )

    found = files.select(F.col("shard").cast("bigint"), "content")
    return found.mapInArrow(run, "slot bigint, shard bigint, tokens array<int>")


def segments(spark: SparkSession, path: str) -> DataFrame:
    """(slot, segments): the documents of each slot, in the order of its tokens."""
    return spark.read.schema(f"slot bigint, segments {SEGMENTS}").parquet(f"{path}/segments")
