"""Word-level BPE with word ends: exact encoding by dynamic programming over prefixes, and decoding.

A text is cut at the special tokens, normalised and split into words as the tokenizer file says.
A word is a string over 512 symbols: its bytes, the last one in a form of its own that ends words.
A suffix automaton of all vocabulary entries reads the word; at each position its state and suffix
links name the entries that end there. For every prefix of a word exactly one of these entries is
the last token of the prefix's encoding: the one that starts the word, or that is compatible with
the last token of the prefix before it (merging both together gives both again; memoised). Stored
for every prefix, these last tokens are back-pointers from the end of the word to its ids. A word
takes time in proportion to its length and the entries that end at a position.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, Tokenizer, pre_tokenizers

from lamina.llm.common import slices

#: Memory bounds of one worker's caches; beyond them nothing is remembered, results are the same.
WORDS_KEPT, WORD_CHARS_KEPT, PAIRS_KEPT = 400_000, 64, 400_000

#: Symbols of bytes that end a word start here.
FINAL = 256


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in byte-level vocabularies, and its byte.

    Printable Latin-1 letters stand for themselves, the other bytes take letters from 256 on.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}


class SuffixAutomaton:
    """All substrings of a set of words; the states of the words themselves carry a token.

    A word is the longest string of its state, so a state has one token at most. ``token`` is -1
    for other states; ``above`` is the nearest state on the suffix links that has a token (0: none).
    """

    def __init__(self):
        self.next: list[dict[str, int]] = [{}]
        self.link, self.length, self.token, self.above = [-1], [0], [-1], [0]

    def _state(self, length: int, link: int, following: dict[str, int]) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        self.token.append(-1)
        return len(self.next) - 1

    def _split(self, before: int, symbol: str, state: int) -> int:
        """A state for the strings of ``state`` that one more symbol after ``before`` gives."""
        shorter = self._state(self.length[before] + 1, self.link[state], dict(self.next[state]))
        self.link[state] = shorter
        while before >= 0 and self.next[before].get(symbol) == state:
            self.next[before][symbol] = shorter
            before = self.link[before]
        return shorter

    def _extended(self, at: int, symbol: str) -> int:
        known = self.next[at].get(symbol)
        if known is not None:
            return known if self.length[known] == self.length[at] + 1 else self._split(at, symbol, known)
        new = self._state(self.length[at] + 1, 0, {})
        while at >= 0 and symbol not in self.next[at]:
            self.next[at][symbol] = new
            at = self.link[at]
        if at >= 0:
            known = self.next[at][symbol]
            self.link[new] = (
                known if self.length[known] == self.length[at] + 1 else self._split(at, symbol, known)
            )
        return new

    def add(self, word: str, token: int) -> None:
        state = 0
        for symbol in word:
            state = self._extended(state, symbol)
        self.token[state] = token

    def close(self) -> None:
        """Find ``above`` of every state; no word may be added after this."""
        self.above = [0] * len(self.next)
        # a suffix link leads to shorter strings
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            up = self.link[state]
            self.above[state] = up if self.token[up] >= 0 else self.above[up]


class Vocabulary:
    """Entries, merges and word splitting of a tokenizer file of the kind this operator handles."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as source:
            plan = json.load(source)
        model, letters = plan["model"], byte_letters()
        end = model.get("end_of_word_suffix") or ""
        steps = plan["pre_tokenizer"]["pretokenizers"]
        unlike = [model["type"] != "BPE", not end, model["unk_token"], model["dropout"], plan["decoder"]]
        unlike += [model["continuing_subword_prefix"], model["byte_fallback"], model["ignore_merges"]]
        unlike += [[s["type"] for s in steps] != ["Split", "ByteLevel"], not steps[0]["invert"]]
        unlike += [t[k] for t in plan["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized")]
        if any(unlike):
            raise ValueError(f"{path}: not a byte-level BPE with word ends and plain special tokens")

        def symbols(entry: str) -> str:
            ends = entry.endswith(end)
            spelled = [letters[c] for c in (entry[: -len(end)] if ends else entry)]
            return "".join(map(chr, [*spelled[:-1], spelled[-1] + FINAL * ends]))

        self.names = {i: entry for entry, i in model["vocab"].items()}
        self.names |= {t["id"]: t["content"] for t in plan["added_tokens"]}
        self.special = {t["content"]: t["id"] for t in plan["added_tokens"]}
        self.spelling = {i: symbols(entry) for entry, i in model["vocab"].items()}
        self.base = {s: i for i, s in self.spelling.items() if len(s) == 1}
        if len(self.base) < 2 * FINAL:
            raise ValueError(f"{path}: a byte has no entry of its own")
        #: rank and result of each merge, and the merge that makes an entry: rank and halves
        self.merges, self.made = {}, {}
        for rank, (left, right) in enumerate(model["merges"]):
            a, b, c = (model["vocab"][x] for x in (left, right, left + right))
            if c in self.made:
                raise ValueError(f"{path}: two merges make one entry")
            self.merges[a, b], self.made[c] = (rank, c), (rank, a, b)
        # the library's own Unicode tables, for texts beyond the oldest blocks
        self.normaliser = Tokenizer.from_file(path).normalizer
        pattern = steps[0]["pattern"]["Regex"]
        self.splitter = pre_tokenizers.Split(Regex(pattern), "removed", invert=True)
        self.find = regex.compile(pattern).findall
        self.late = regex.compile("[^\u0000-˿]").search
        either = sorted(map(regex.escape, self.special), key=len, reverse=True)
        self.cut = regex.compile(f"({'|'.join(either)})").split if either else lambda text: [text]

    def words(self, text: str) -> list[str]:
        """The words of a text without special tokens.

        Below U+0300 nothing composes and letters have not changed their classes for decades, so
        that composing is left out; all other texts are normalised and split by the library.
        """
        if self.late(text):
            found = self.splitter.pre_tokenize_str(self.normaliser.normalize_str(text))
            return [word for word, _ in found]
        return self.find(text.lower())

    def merged(self, word: str) -> list[int]:
        """Merge by rank, lowest and leftmost first: the definition, for short words of symbols."""
        parts = [self.base[s] for s in word]
        while len(parts) > 1:
            steps = [(*self.merges.get(pair, (len(self.merges), -1)), n) for n, pair in enumerate(zip(parts, parts[1:]))]
            _, made, at = min(steps, key=lambda step: (step[0], step[2]))
            if made < 0:
                break
            parts[at : at + 2] = [made]
        return parts


class Encoder(dict):
    """Maps a word to its packed int32 ids; a missing word is encoded, short ones are kept."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.pairs: dict[int, bool] = {}
        self.automaton = SuffixAutomaton()
        for token, word in vocabulary.spelling.items():
            # entries that merging never makes are left out
            if vocabulary.merged(word) == [token]:
                self.automaton.add(word, token)
        self.automaton.close()

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging the symbols of two tokens together gives these two tokens.

        The merges that made them are undone, the latest first (of one rank the right one is
        later); it does unless the parts at the border would have merged before the undone step.
        """
        merges, made = self.vocabulary.merges, self.vocabulary.made
        never = len(merges)
        until = never
        while True:
            across = merges.get((left, right))
            if across is not None and across[0] < until:
                return False
            a, b = made.get(left, (-1,)), made.get(right, (-1,))
            if a[0] < 0 and b[0] < 0:
                return True
            if a[0] > b[0]:
                until, left = a[0], a[2]
            else:
                until, right = b[0] + 1, b[1]

    def last_tokens(self, word: str) -> list[int]:
        """For each prefix of a word of symbols, the last token of its encoding (-1: no symbols)."""
        automaton, pairs = self.automaton, self.pairs
        following, link, length = automaton.next, automaton.link, automaton.length
        token_of, above = automaton.token, automaton.above
        last, state, matched = [-1] * (len(word) + 1), 0, 0
        for end, symbol in enumerate(word, 1):
            while (reached := following[state].get(symbol)) is None:
                state = link[state]
                matched = length[state]
            state, matched = reached, matched + 1
            ending = state if matched == length[state] and token_of[state] >= 0 else above[state]
            while True:
                token, start = token_of[ending], end - length[ending]
                if start == 0:
                    break
                key = last[start] << 32 | token
                fits = pairs.get(key)
                if fits is None:
                    fits = self.compatible(last[start], token)
                    if len(pairs) < PAIRS_KEPT:
                        pairs[key] = fits
                if fits:
                    break
                ending = above[ending]
            last[end] = token
        return last

    def encode_word(self, word: str) -> list[int]:
        raw = word.encode("utf-8")
        last = self.last_tokens(raw[:-1].decode("latin-1") + chr(raw[-1] + FINAL))
        spelling, end, out = self.vocabulary.spelling, len(raw), []
        while end:
            out.append(last[end])
            end -= len(spelling[last[end]])
        return out[::-1]

    def __missing__(self, word: str) -> bytes:
        packed = np.array(self.encode_word(word), dtype="<i4").tobytes()
        if len(word) <= WORD_CHARS_KEPT and len(self) < WORDS_KEPT:
            self[word] = packed
        return packed

    def encode(self, text: str) -> np.ndarray:
        parts, vocabulary = [], self.vocabulary
        for n, piece in enumerate(vocabulary.cut(text)):
            if n % 2:
                parts.append(np.array([vocabulary.special[piece]], dtype="<i4").tobytes())
            elif piece:
                parts.extend(map(self.__getitem__, vocabulary.words(piece)))
        return np.frombuffer(b"".join(parts), dtype="<i4")


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """This process's encoder for a tokenizer file (built once per worker)."""
    if path not in _encoders:
        _encoders[path] = Encoder(Vocabulary(path))
    return _encoders[path]


def decoded(ids: list[int] | None, names: dict[int, str]) -> str:
    """The tokens as the file spells them, with blanks between; an unknown id is an error."""
    try:
        return " ".join([names[i] for i in ids or ()])
    except KeyError as unknown:
        raise ValueError(f"id outside the vocabulary: {unknown}") from None


def encode(docs: DataFrame, text_column: str, tokenizer_path: str, keep: list[str], round_trip: bool = False) -> DataFrame:
    """``docs[keep]`` with ``ids`` (array of int): the tokens of the whole text.

    Special tokens in the text get their ids, none are added; nothing is cut or padded. A null, empty
    or blank text has no ids; a text of any length is encoded whole. Repeated rows stay, an empty table
    gives an empty one, other columns are not read. With ``round_trip`` the ids are decoded again into
    ``decoded`` (string). The added names may not be kept ones. Each executor reads ``tokenizer_path``.
    """
    added = ["ids", "decoded"] if round_trip else ["ids"]
    if set(added) & set(keep):
        raise ValueError(f"a kept column may not be called {' or '.join(added)}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = encoder(tokenizer_path)
        names = model.vocabulary.names
        for batch in batches:
            for part in slices(batch, 0):
                found = [model.encode(t) if t else np.empty(0, "<i4") for t in part.column(0).to_pylist()]
                ends = pa.array(np.cumsum([0, *map(len, found)]), pa.int32())
                columns = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate([np.empty(0, "<i4"), *found]), pa.int32()))]
                if round_trip:
                    columns.append(pa.array([decoded(ids.tolist(), names) for ids in found], pa.string()))
                yield pa.RecordBatch.from_arrays([*part.columns[1:], *columns], [*keep, *added])

    kinds = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep]
    kinds += ["ids array<int>", "decoded string"][: len(added)]
    source = docs.select(docs[text_column].alias("__text"), *[docs[c] for c in keep])
    return source.mapInArrow(run, ", ".join(kinds))


def decode(tokens: DataFrame, ids_column: str, tokenizer_path: str) -> DataFrame:
    """``tokens`` with ``decoded`` (string), the text of its ids; null ids decode to empty text.

    An id outside the vocabulary is an error. A column called ``decoded`` is replaced.
    """
    keep = [c for c in tokens.columns if c != "decoded"]
    at = keep.index(ids_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = encoder(tokenizer_path).vocabulary.names
        for batch in batches:
            for part in slices(batch, at):
                texts = pa.array([decoded(ids, names) for ids in part.column(at).to_pylist()], pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns, texts], [*keep, "decoded"])

    kinds = [f"`{c}` {tokens.schema[c].dataType.simpleString()}" for c in keep]
    return tokens.select(*keep).mapInArrow(run, ", ".join([*kinds, "decoded string"]))


def digests(docs: DataFrame, id_column: str, text_column: str, tokenizer_path: str) -> DataFrame:
    """Encode, decode and condense: id, n_tokens, ids_sha256, decoded_sha256. Odd rows as in ``encode``."""
    tokens = encode(docs, text_column, tokenizer_path, [id_column], round_trip=True)
    return tokens.select(
        id_column,
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
