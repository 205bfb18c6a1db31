"""Bigram language-model scores from Elias-Fano tries, trained on the corpus itself.

p(w | v) = (c(v, w) + MU * p(w)) / (c(v) + MU), with p(w) the add-0.1 unigram; every text starts
behind an end token. The work goes in blocks of documents, packed as binary arrays:

1. Blocks number their own words; the table of blocks is written once.
2. Each block's distinct words go to the words' shards, which count them, give every word a
   number and answer each block with the numbers and counts of its words.
3. Each block sends its distinct bigrams and their training counts, with the coded unigram
   probability and the coded weight of the context, to the bigrams' shards. A shard sums the
   counts, builds a trie of smoothed 16-bit log probabilities in a mapped file, looks up the
   bigrams and sends each block one coded log probability for each of its bigrams.
4. Blocks find their bigrams' occurrences in each document once more and add the codes up; only
   distinct bigrams and their codes are ever exchanged.

Shards are by (context, word modulo 16 or the number of shards, if larger), and repeats are
summed in the block: a frequent context is spread over the shards, a frequent pair is one entry
per block. Nothing of the size of the vocabulary meets in one place.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import Staged, id_remainder
from lamina.llm.elias_fano import Trie

#: Weight of the unigram in a context's distribution, in counts.
MU = 8.0
#: Add-constant of the unigram.
ADD = 0.1
#: Log10 probabilities are stored as multiples of this step, in 16 bits.
STEP = 1 / 2048
#: Tokens in a block, documents in a block, tokens for each bigram shard, documents for each word shard.
BLOCK_TOKENS, BLOCK_DOCS, SHARD_TOKENS, SHARD_DOCS = 1 << 19, 1 << 15, 1 << 21, 8192
#: A context's successors are dealt out in so many parts, or as many as there are shards.
PARTS = 16
#: The end token: no word holds white space.
END = b" "


def _code(log10: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(-log10 / STEP), 0, 65535).astype("<u2")


def _log(codes: np.ndarray) -> np.ndarray:
    return codes.astype(np.float64) * -STEP


def _binary(array: np.ndarray) -> bytes:
    """Compressed bytes of an array, the bytes of equal weight together."""
    planes = np.ascontiguousarray(array).view(np.uint8).reshape(len(array), array.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _text(words) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b"\n".join(words))


def _array(packed: bytes, kind: str) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompress(packed)
    size = np.dtype(kind).itemsize
    return np.frombuffer(raw, np.uint8).reshape(size, -1).T.copy().view(kind).reshape(-1)


def _mixed(values: np.ndarray) -> np.ndarray:
    """Well-spread 64-bit hashes of integers."""
    x = values.astype(np.uint64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


class _Block:
    """Documents gathered until a block is full."""

    def __init__(self):
        self.words: dict[bytes, int] = {END: 0}
        self.ids, self.held, self.ends, self.tokens, self.size = [], [], [], [], 0

    def add(self, key, held: bool, text: bytes | None) -> None:
        words, known = (text or b"").lower().split(), self.words
        found = [known.setdefault(w, len(known)) for w in words]
        found.append(0)
        self.tokens.append(np.array(found, dtype=np.uint32))
        self.size += len(found)
        self.ids.append(key)
        self.held.append(held)
        self.ends.append(self.size)

    def full(self) -> bool:
        return self.size >= BLOCK_TOKENS or len(self.ids) >= BLOCK_DOCS

    def rows(self, number: int, shards: int) -> list[dict]:
        """A row of documents, and one of distinct words and training counts per word shard."""
        names = np.array(list(self.words), dtype=object)
        tokens = np.concatenate(self.tokens)
        shard = np.fromiter((_word_shard(w, shards) for w in names), dtype=np.int64, count=len(names))
        order = np.argsort(shard, kind="stable")
        place = np.empty(len(names), dtype=np.uint32)
        place[order] = np.arange(len(names), dtype=np.uint32)
        tokens = place[tokens]
        training = np.repeat(~np.array(self.held), np.diff([0, *self.ends]))
        counts = np.bincount(tokens[training], minlength=len(names)).astype("<u4")
        out = [{"block": number, "shard": -1, "ids": self.ids, "held": _binary(np.array(self.held)),
                "ends": _binary(np.array(self.ends, dtype="<i8")), "tokens": _binary(tokens.astype("<u4")),
                "end": int(place[0])}]
        bounds = np.searchsorted(shard[order], np.arange(shards + 1))
        for s in range(shards):
            a, b = bounds[s], bounds[s + 1]
            if a < b:
                out.append({"block": number, "shard": s, "words": _text(names[order[a:b]]),
                            "counts": _binary(counts[a:b])})
        return out


def _word_shard(word: bytes, shards: int) -> int:
    # imported late: the driver needs no hash library
    import xxhash

    return xxhash.xxh3_64_intdigest(word) % shards


def _blocks(docs: DataFrame, shards: int, id_kind: str) -> DataFrame:
    schema = pa.schema(
        [("block", pa.int64()), ("shard", pa.int32()), ("ids", pa.list_(_arrow(id_kind))), ("held", pa.binary()),
         ("ends", pa.binary()), ("tokens", pa.binary()), ("end", pa.int64()), ("words", pa.binary()),
         ("counts", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, number = _Block(), TaskContext.get().partitionId() << 32
        for batch in batches:
            texts = batch.column(2).cast(pa.binary())
            for key, held, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts):
                block.add(key, held, text.as_py())
                if block.full():
                    yield pa.RecordBatch.from_pylist(block.rows(number, shards), schema)
                    block, number = _Block(), number + 1
        if block.ids:
            yield pa.RecordBatch.from_pylist(block.rows(number, shards), schema)

    kinds = f"block bigint, shard int, ids array<{id_kind}>, held binary, ends binary, tokens binary, end bigint"
    return docs.mapInArrow(run, kinds + ", words binary, counts binary")


def _arrow(id_kind: str) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[id_kind]


def _answers(words: DataFrame, shards: int) -> DataFrame:
    """(block, shard, numbers, counts): of each block's words, in its order; block -1 has the sums."""

    def run(group: pa.Table) -> pa.Table:
        shard = group.column("shard")[0].as_py()
        totals: dict[bytes, int] = {}
        lists = [(b, zstandard.ZstdDecompressor().decompress(w).split(b"\n"), _array(c, "<u4")) for b, w, c in zip(
            group.column("block").to_pylist(), group.column("words").to_pylist(), group.column("counts").to_pylist())]
        for _, names, counts in lists:
            for name, count in zip(names, counts.tolist()):
                totals[name] = totals.get(name, 0) + count
        number = {name: i * shards + shard for i, name in enumerate(sorted(totals))}
        out = [
            (block, shard, _binary(np.array([number[w] for w in names], dtype="<i8")),
             _binary(np.array([totals[w] for w in names], dtype="<i8")))
            for block, names, _ in lists
        ]
        sums = np.array([sum(totals.values()), sum(c > 0 for c in totals.values())], dtype="<i8")
        out.append((-1, shard, b"", _binary(sums)))
        columns = [pa.array(c) for c in zip(*out)]
        columns[1] = columns[1].cast(pa.int32())
        return pa.table(columns, names=["block", "shard", "numbers", "counts"])

    return words.groupBy("shard").applyInArrow(run, "block bigint, shard int, numbers binary, counts binary")


#: Of a block's bigrams by context and word: contexts as steps, places in the distinct words (steps, too),
#: training counts; one code per distinct context and per distinct word.
_GRAMS = ("v", "w", "words", "train", "context", "word")
_SENT = "shard int, block bigint, " + ", ".join(f"{c} binary" for c in _GRAMS)


def _norm(total: int, distinct: int) -> float:
    return np.log10(total + ADD * (distinct + 1)) if total or distinct else np.log10(ADD)


class _Numbered:
    """A block whose words have the numbers and counts of the corpus, and its bigrams in the order sent."""

    def __init__(self, row: dict, shards: int):
        parts = sorted(row["parts"], key=lambda p: p["shard"])
        number = np.concatenate([_array(p["numbers"], "<i8") for p in parts])
        self.count = np.concatenate([_array(p["counts"], "<i8") for p in parts])
        self.tokens, ends = _array(row["tokens"], "<u4"), _array(row["ends"], "<i8")
        self.held = _array(row["held"], "?")
        self.starts, self.sizes = np.concatenate([[0], ends[:-1]]), np.diff([0, *ends])
        before = np.concatenate([[0], self.tokens[:-1]]).astype(np.uint32)
        before[self.starts] = row["end"]
        doc = np.repeat(np.arange(len(ends), dtype=np.uint32), self.sizes)
        v, w = number[before], number[self.tokens]
        spans = max(PARTS, shards)
        shard = (_mixed(v * spans + w % spans) % np.uint64(shards)).astype(np.int64)
        order = np.lexsort((doc, w, v, shard))
        v, w, self.doc = v[order], w[order], doc[order]
        self.new = (np.diff(v, prepend=-1) != 0) | (np.diff(w, prepend=-1) != 0)
        self.first = np.flatnonzero(self.new)
        # distinct bigrams, the shard of each, and the token where it occurs first
        self.v, self.w, self.shard, self.at = v[self.first], w[self.first], shard[order][self.first], order[self.first]
        self.before = before


def _bigrams(blocks: DataFrame, total: int, distinct: int, shards: int) -> DataFrame:
    """What each block sends to each bigram shard: its distinct bigrams there and their training counts."""
    norm = _norm(total, distinct)
    kinds = pa.schema([("shard", pa.int32()), ("block", pa.int64())] + [(c, pa.binary()) for c in _GRAMS])

    def one(row: dict) -> pa.RecordBatch:
        own = _Numbered(row, shards)
        train = np.add.reduceat((~own.held)[own.doc].astype("<i8"), own.first).astype("<u4")
        context = _code(np.log10(MU / (own.count + MU)))[own.before[own.at]]
        word = _code(np.log10(own.count + ADD) - norm)[own.tokens[own.at]]
        bounds = np.searchsorted(own.shard, np.arange(shards + 1))
        out = []
        for s in np.flatnonzero(np.diff(bounds)).tolist():
            p = slice(bounds[s], bounds[s + 1])
            words, at, place = np.unique(own.w[p], return_index=True, return_inverse=True)
            out.append({
                "shard": s, "block": row["block"], "v": _binary(np.diff(own.v[p], prepend=0).astype("<i8")),
                "w": _binary(place.astype("<u4")), "words": _binary(np.diff(words, prepend=0).astype("<i8")),
                "train": _binary(train[p]), "context": _binary(context[p][np.diff(own.v[p], prepend=-1) != 0]),
                "word": _binary(word[p][at]),
            })
        return pa.RecordBatch.from_pylist(out, kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                yield one({c: batch.column(c)[r].as_py() for c in batch.schema.names})

    return blocks.mapInArrow(run, _SENT)


def _scored(sent: DataFrame) -> DataFrame:
    """(block, part, codes) of every shard and block: a code for each bigram the block sent there."""

    def run(rows: pa.Table) -> pa.Table:
        grams = [_unpacked(*(rows.column(c)[r].as_py() for c in _GRAMS)) for r in range(rows.num_rows)]
        ends = np.cumsum([len(g[0]) for g in grams])
        codes = _grams(*(np.concatenate(x) for x in zip(*grams)))
        packed = [_binary(x.astype("<u4")) for x in np.split(codes, ends[:-1])]
        return pa.table({"block": rows.column("block"), "part": rows.column("shard"), "codes": pa.array(packed, pa.binary())})

    return sent.groupBy("shard").applyInArrow(run, "block bigint, part int, codes binary")


def _unpacked(v: bytes, w: bytes, words: bytes, train: bytes, context: bytes, word: bytes) -> tuple[np.ndarray, ...]:
    """Context, word, their codes and the training count of each bigram a block sent."""
    contexts, place = np.cumsum(_array(v, "<i8")), _array(w, "<u4")
    which = np.cumsum(np.diff(contexts, prepend=-1) != 0) - 1
    return (
        contexts, np.cumsum(_array(words, "<i8"))[place], _array(context, "<u2")[which], _array(word, "<u2")[place],
        _array(train, "<u4"),
    )


def _grams(v, w, context, word, train) -> np.ndarray:
    """Coded log10 probability of each block's bigrams, by a trie of those with training counts ``train``."""
    order = np.lexsort((w, v))
    new = np.empty(len(v), "?")
    new[:1] = True
    new[1:] = (v[order][1:] != v[order][:-1]) | (w[order][1:] != w[order][:-1])
    first, gram = order[new], np.empty(len(v), dtype=np.int64)
    gram[order] = np.cumsum(new) - 1
    counts = np.bincount(gram, weights=train, minlength=len(first))
    # p(w | v) = weight of the unigram * (p(w) + c(v, w) / MU)
    smoothed = _log(context[first]) + np.log10(10 ** _log(word[first]) + counts / MU)
    seen = counts > 0
    result = context[first].astype(np.int64) + word[first]
    with tempfile.TemporaryDirectory(prefix="ngrams-") as folder:
        layout = Trie.write(f"{folder}/trie", v[first][seen], w[first][seen], _code(smoothed[seen]))
        trie = Trie(f"{folder}/trie", layout)
        at = trie.find(v[first], w[first])
        result[at >= 0] = trie.codes[at[at >= 0]]
        del trie
    return result[gram]


def score(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", folds: int = 10) -> DataFrame:
    """One row (id, held_out, n_tokens, n_known, train_tokens, base_score, score) per row of ``docs``.

    The model learns from the texts whose id's crc32 modulo ``folds`` is not 0 and scores all.
    A null text is empty, an empty text is one end token; a null id is held out. Repeated rows
    are texts of their own. An empty table gives an empty result, and without any training text
    every token has the unigram's smoothed probability of an unseen one.
    """
    id_kind = docs.schema[id_column].dataType.simpleString()
    if id_kind not in ("bigint", "int", "string"):
        raise ValueError(f"ids of type {id_kind} are not supported")
    rows = docs.select(docs[id_column].alias("id"), docs[text_column].alias("text"))
    rows = rows.select("id", (id_remainder("id", folds) == 0).alias("held"), "text")
    shards = max(8, -(-rows.count() // SHARD_DOCS))
    blocks = Staged(_blocks(rows, shards, id_kind), "lm-blocks")
    words = blocks.df.where("shard >= 0").select("block", "shard", "words", "counts")
    answers = Staged(_answers(words, shards), "lm-words")
    # of every word shard its sums, which tasks add up
    sums = answers.df.where("block = -1").select("counts").mapInArrow(_summed, "total bigint, kinds bigint")
    total, distinct = sums.agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("kinds"), F.lit(0))).first()
    parts = answers.df.where("block >= 0").groupBy("block").agg(
        F.collect_list(F.struct("shard", "numbers", "counts")).alias("parts")
    )
    texts = blocks.df.where("shard = -1").select("block", "ids", "held", "ends", "tokens", "end")
    numbered = Staged(texts.join(parts, "block"), "lm-texts")
    blocks.drop()
    answers.drop()
    gram_shards = max(8, -(-total // SHARD_TOKENS))
    scored = Staged(_scored(_bigrams(numbered.df, total, distinct, gram_shards)), "lm-codes")
    norm = _norm(total, distinct)

    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        row = {c: texts.column(c)[0].as_py() for c in texts.schema.names}
        own = _Numbered(row, gram_shards)
        parts = sorted(zip(answers.column("part").to_pylist(), answers.column("codes").to_pylist()))
        codes = np.concatenate([_array(x, "<u4") for _, x in parts]).astype(np.int64)
        # bigrams were sent by shard; sums of whole codes are exact
        places = codes[np.cumsum(own.new) - 1]
        sums = _log(np.bincount(own.doc, weights=places, minlength=len(row["ids"])))
        unigram = np.log10(own.count + ADD) - norm
        return pa.table({
            "id": pa.array(row["ids"], _arrow(id_kind)), "held_out": own.held, "n_tokens": own.sizes.astype("<i8"),
            "n_known": np.add.reduceat((own.count > 0)[own.tokens].astype("<i8"), own.starts),
            "train_tokens": np.full(len(row["ids"]), total), "base_score": np.add.reduceat(unigram[own.tokens], own.starts),
            "score": sums,
        })

    # a group is one block and the codes of its bigrams
    return numbered.df.groupBy("block").cogroup(scored.df.groupBy("block")).applyInArrow(
        run,
        f"id {id_kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
        "base_score double, score double",
    )


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Training tokens and distinct words of the word shards whose packed sums come in."""
    for batch in batches:
        sums = [_array(packed, "<i8") for packed in batch.column(0).to_pylist()]
        columns = [pa.array([int(x[n]) for x in sums], pa.int64()) for n in (0, 1)]
        yield pa.RecordBatch.from_arrays(columns, ["total", "kinds"])
