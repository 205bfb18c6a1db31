"""Byte-level BPE: exact encoding by backtracking over longest matches, and decoding.

Vocabulary bytes become Latin-1 characters for the Aho-Corasick automaton, which names the
vocabulary entries ending at each byte of a piece in one sweep. The encoder walks over the
longest match at each position, accepts a token when it is compatible with the one before
(both stay as they are when their joined bytes are merged alone; memoised), tries shorter
entries otherwise, and steps back past positions that cannot be completed. Each position is
given up once at most, so a piece takes linear time whatever its length.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import slices

#: Memory bounds of one worker's caches; beyond them nothing is remembered, results are the same.
WORDS_KEPT, WORD_BYTES_KEPT, PAIRS_KEPT = 400_000, 64, 400_000


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their rank from a rank file (one base64 token and rank per line)."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


#: A rank above all others: never merged.
NEVER = 1 << 40


def merged(piece: bytes, ranks: dict[bytes, int], parts_left: int = 1) -> list[bytes]:
    """Merge by rank, lowest and leftmost first: the definition, for short byte strings.

    Stops when ``parts_left`` parts are left.
    """
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > parts_left:
        order = [ranks.get(a + b, NEVER) for a, b in zip(parts, parts[1:])]
        best = min(order)
        if best == NEVER:
            break
        at = order.index(best)
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts


class Encoder(dict):
    """Maps a pre-token to its packed int32 ids; a missing key is encoded, short ones are kept."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.split = regex.compile(pattern).findall
        self.names = {rank: token for token, rank in ranks.items()}
        self.sizes = {rank: len(token) for token, rank in ranks.items()}
        self.pairs: dict[int, bool] = {}
        self.shorter: dict[int, int | None] = {}
        self.edges: dict[tuple[bytes, bool], list[tuple[bytes, int]]] = {}
        self.automaton = ahocorasick.Automaton()
        self.reached = set()
        for token, rank in ranks.items():
            # entries that merging never makes are only used for a piece equal to them
            if len(token) == 1 or merged(token, ranks) == [token]:
                self.reached.add(rank)
                self.automaton.add_word(token.decode("latin-1"), (rank, len(token)))
        self.automaton.make_automaton()

    def edge(self, token: bytes, right: bool) -> list[tuple[bytes, int]]:
        """What stands at one end of ``token`` while it is merged from bytes, earliest first.

        Each part comes with the rank of the merge that ends it; the token itself never ends.
        """
        found = self.edges.get((token, right))
        if found is None:
            if len(token) == 1:
                found = [(token, NEVER)]
            else:
                half = merged(token, self.ranks, 2)[right]
                below = self.edge(half, right)
                found = [*below[:-1], (half, self.ranks[token]), (token, NEVER)]
            self.edges[token, right] = found
        return found

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging the joined bytes of two tokens gives these two tokens.

        It does unless, at some time, the parts that meet at the border merge before either
        of them is merged into its own token (of equal ranks the leftmost merge is first).
        """
        ranks = self.ranks
        ends, begins = self.edge(self.names[left], True), self.edge(self.names[right], False)
        i = j = 0
        while True:
            (x, x_ends), (y, y_ends) = ends[i], begins[j]
            across = ranks.get(x + y, NEVER)
            if across < x_ends and across <= y_ends and across < NEVER:
                return False
            if x_ends == y_ends == NEVER:
                return True
            if x_ends <= y_ends:
                i += 1
            else:
                j += 1

    def prefix(self, rank: int) -> int | None:
        """The longest usable entry that is a proper prefix of this one."""
        if rank not in self.shorter:
            token, found = self.names[rank], None
            for size in range(len(token) - 1, 0, -1):
                found = self.ranks.get(token[:size])
                if found is not None and found in self.reached:
                    break
                found = None
            self.shorter[rank] = found
        return self.shorter[rank]

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        size = len(piece)
        longest: list[int | None] = [None] * (size + 1)
        for end, (rank, width) in self.automaton.iter(piece.decode("latin-1")):
            # matches that end later are longer from the same start
            longest[end - width + 1] = rank
        sizes, pairs, prefix = self.sizes, self.pairs, self.prefix
        possible, out, at, token, before = bytearray(b"\x01" * (size + 1)), [], 0, longest[0], -1
        while at < size:
            while token is not None:
                end = at + sizes[token]
                if possible[end]:
                    if before < 0:
                        fits = True
                    else:
                        fits = pairs.get(before << 32 | token)
                        if fits is None:
                            fits = self.compatible(before, token)
                            if len(pairs) < PAIRS_KEPT:
                                pairs[before << 32 | token] = fits
                    if fits:
                        out.append(token)
                        at, before, token = end, token, longest[end]
                        break
                token = prefix(token)
            else:
                possible[at] = 0
                token = out.pop()
                at -= sizes[token]
                before = out[-1] if out else -1
        return out

    def __missing__(self, piece: str) -> bytes:
        raw = piece.encode("utf-8")
        packed = np.array(self.encode_piece(raw), dtype="<i4").tobytes()
        if len(raw) <= WORD_BYTES_KEPT and len(self) < WORDS_KEPT:
            self[piece] = packed
        return packed

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.__getitem__, self.split(text))), dtype="<i4")


class Decoder:
    """Concatenates token bytes with array operations."""

    def __init__(self, ranks: dict[bytes, int]):
        size = max(ranks.values(), default=-1) + 1
        names = {rank: token for token, rank in ranks.items()}
        self.known = np.array([i in names for i in range(size)], dtype=bool)
        self.lengths = np.array([len(names.get(i, b"")) for i in range(size)], dtype=np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]]) if size else self.lengths
        self.bytes = np.frombuffer(b"".join(names.get(i, b"") for i in range(size)), dtype=np.uint8)

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All bytes of ``ids`` and the number of bytes of each id; an unknown id is an error."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.known) or not self.known[ids].all()):
            raise ValueError("id outside the vocabulary")
        sizes = self.lengths[ids]
        ends = np.cumsum(sizes)
        shift = np.repeat(self.starts[ids] - (ends - sizes), sizes)
        return self.bytes[np.arange(len(shift)) + shift], sizes


_encoders: dict[tuple, Encoder] = {}
_decoders: dict[str, Decoder] = {}


def encoder(path: str, pattern: str) -> Encoder:
    """This process's encoder for a rank file (built once per worker)."""
    if (path, pattern) not in _encoders:
        _encoders[path, pattern] = Encoder(load_ranks(path), pattern)
    return _encoders[path, pattern]


def decoder(path: str) -> Decoder:
    if path not in _decoders:
        _decoders[path] = Decoder(load_ranks(path))
    return _decoders[path]


def _id_lists(found: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, found)])
    values = np.concatenate(found) if found else np.empty(0, "<i4")
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int32()))


def _bytes_of(lists: pa.ListArray, model: Decoder) -> pa.Array:
    counts = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    raw, sizes = model.decode(lists.flatten().to_numpy(zero_copy_only=False))
    byte_ends = np.concatenate([[0], np.cumsum(sizes)])
    ends = byte_ends[np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)].astype("<i4")
    buffers = [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(raw.tobytes())]
    return pa.Array.from_buffers(pa.binary(), len(lists), buffers)


def encode(
    docs: DataFrame, text_column: str, ranks_path: str, pattern: str, keep: list[str], round_trip: bool = False
) -> DataFrame:
    """``docs[keep]`` with ``ids`` (array of int): the tokens of the whole text, no special tokens.

    Each match of ``pattern`` is encoded separately. A null or empty text has no ids; rows keep
    their number and order within a partition, other columns are not read. With ``round_trip``
    the ids are decoded again into ``decoded`` (binary). The added names may not be kept ones.
    The rank file is read on each executor from ``ranks_path``.
    """
    added = ["ids", "decoded"] if round_trip else ["ids"]
    if set(added) & set(keep):
        raise ValueError(f"a kept column may not be called {' or '.join(added)}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = encoder(ranks_path, pattern)
        back = decoder(ranks_path) if round_trip else None
        for batch in batches:
            for part in slices(batch, 0):
                texts = part.column(0).to_pylist()
                ids = _id_lists([model.encode(t) if t else np.empty(0, "<i4") for t in texts])
                columns = [ids, _bytes_of(ids, back)] if back else [ids]
                yield pa.RecordBatch.from_arrays([*part.columns[1:], *columns], [*keep, *added])

    kinds = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep]
    kinds += ["ids array<int>", "decoded binary"][: len(added)]
    source = docs.select(docs[text_column].alias("__text"), *[docs[c] for c in keep])
    return source.mapInArrow(run, ", ".join(kinds))


def decode(tokens: DataFrame, ids_column: str, ranks_path: str) -> DataFrame:
    """``tokens`` with ``decoded`` (binary), the bytes of its ids; null ids decode to no bytes.

    An id outside the vocabulary is an error. A column called ``decoded`` is replaced.
    """
    keep = [c for c in tokens.columns if c != "decoded"]
    at = keep.index(ids_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = decoder(ranks_path)
        for batch in batches:
            for part in slices(batch, at):
                yield pa.RecordBatch.from_arrays([*part.columns, _bytes_of(part.column(at), model)], [*keep, "decoded"])

    kinds = [f"`{c}` {tokens.schema[c].dataType.simpleString()}" for c in keep]
    return tokens.select(*keep).mapInArrow(run, ", ".join([*kinds, "decoded binary"]))


def digests(docs: DataFrame, id_column: str, text_column: str, ranks_path: str, pattern: str) -> DataFrame:
    """Encode, decode and condense: id, n_tokens, ids_sha256, decoded_sha256."""
    tokens = encode(docs, text_column, ranks_path, pattern, [id_column], round_trip=True)
    return tokens.select(
        id_column,
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
