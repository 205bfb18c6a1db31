"""Elias-Fano sequences and a two-level n-gram trie made of them, in one memory-mapped file.

A sequence of n increasing integers below u keeps the low bits of each value as they are and the
high bits as one unary bit vector, about 2 + log2(u / n) bits a value. Queries take arrays.
"""

from __future__ import annotations

import math

import numpy as np

#: Queries answered at a time; bounds the unpacked words.
CHUNK = 1 << 15


#: Position of the k-th set bit of each byte.
_IN_BYTE = np.array(
    [[[j for j in range(8) if b >> j & 1][k] if k < bin(b).count("1") else 0 for k in range(8)] for b in range(256)],
    dtype=np.int64,
)


def _select(words: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Position of the set bit number ``rank`` (from 0) in each 64-bit word."""
    parts = np.ascontiguousarray(words).view(np.uint8).reshape(-1, 8)
    ones = np.cumsum(np.bitwise_count(parts), axis=1, dtype=np.int64)
    at = (ones <= ranks[:, None]).sum(axis=1)
    row = np.arange(len(at))
    before = np.where(at > 0, ones[row, at - 1], 0)
    return at * 8 + _IN_BYTE[parts[row, at], ranks - before]


class EliasFano:
    """Non-decreasing integers below ``universe``, from the arrays that ``pack`` returns."""

    def __init__(self, size: int, width: int, low: np.ndarray, high: np.ndarray, ones: np.ndarray):
        self.size, self.width, self.low, self.high, self.ones = size, width, low, high, ones
        # unset bits before each word, for the search by high part
        self.zeros = np.arange(len(ones), dtype=np.int64) * 64 - ones

    @staticmethod
    def pack(values: np.ndarray, universe: int) -> tuple[int, int, np.ndarray, np.ndarray, np.ndarray]:
        values = values.astype(np.uint64)
        n = len(values)
        width = max(0, int(math.log2(max(1, universe) / n))) if n else 0
        high = (values >> np.uint64(width)).astype(np.int64)
        set_bits = high + np.arange(n, dtype=np.int64)
        # one unset bit closes every high part, the last included
        length = n + (universe >> width) + 1
        flags = np.zeros(-(-length // 64) * 64, dtype=np.uint8)
        flags[set_bits] = 1
        words = np.packbits(flags, bitorder="little").view("<u8")
        ones = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])
        low = np.zeros(n * width // 64 + 2, dtype=np.uint64)
        if width:
            part = values & np.uint64((1 << width) - 1)
            at = np.arange(n, dtype=np.uint64) * np.uint64(width)
            word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            np.bitwise_or.at(low, word, part << shift)
            over = (shift + np.uint64(width)) > 64
            np.bitwise_or.at(low, word[over] + 1, part[over] >> (np.uint64(64) - shift[over]))
        return n, width, low, words, ones

    def _lows(self, at: np.ndarray) -> np.ndarray:
        if not self.width:
            return np.zeros(len(at), dtype=np.int64)
        bit = at.astype(np.uint64) * np.uint64(self.width)
        word, shift = (bit >> np.uint64(6)).astype(np.int64), bit & np.uint64(63)
        part = self.low[word] >> shift
        # a shift by 64 is undefined: two shifts
        part = part | ((self.low[word + 1] << np.uint64(1)) << (np.uint64(63) - shift))
        return (part & np.uint64((1 << self.width) - 1)).astype(np.int64)

    def _select_one(self, rank: np.ndarray) -> np.ndarray:
        word = np.searchsorted(self.ones, rank, side="right") - 1
        return word * 64 + _select(self.high[word], rank - self.ones[word])

    def _select_zero(self, rank: np.ndarray) -> np.ndarray:
        word = np.searchsorted(self.zeros, rank, side="right") - 1
        return word * 64 + _select(~self.high[word], rank - self.zeros[word])

    def get(self, at: np.ndarray) -> np.ndarray:
        """Values at positions ``at``."""
        out = np.empty(len(at), dtype=np.int64)
        for i in range(0, len(at), CHUNK):
            part = at[i : i + CHUNK]
            high = self._select_one(part) - part
            out[i : i + CHUNK] = (high << self.width) | self._lows(part)
        return out

    def successor(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Position of the first value that is not smaller, and whether it is equal.

        All ``values`` are below the universe.
        """
        out, equal = np.empty(len(values), dtype=np.int64), np.empty(len(values), dtype=bool)
        for i in range(0, len(values), CHUNK):
            part = values[i : i + CHUNK]
            high = part >> self.width
            low = part & ((1 << self.width) - 1)
            # values with this high part stand between two unset bits
            begin = np.where(high > 0, self._select_zero(np.maximum(high - 1, 0)) - (high - 1), 0)
            end = last = self._select_zero(high) - high
            at = begin
            while True:
                ahead = at < end
                ahead[ahead] = self._lows(at[ahead]) < low[ahead]
                if not ahead.any():
                    break
                # halve what is left where many values share a high part
                step = np.maximum((end - at) // 2, 1)
                probe = at + step
                jump = ahead & (probe < end)
                jump[jump] = self._lows(probe[jump] - 1) < low[jump]
                at = np.where(jump, probe, np.where(ahead, at + 1, at))
                end = np.where(ahead & ~jump, np.minimum(end, probe), end)
            same = at < last
            same[same] = self._lows(at[same]) == low[same]
            out[i : i + CHUNK], equal[i : i + CHUNK] = at, same
        return out, equal


class Trie:
    """Contexts, and below each its successors with a coded probability.

    Level 1: context numbers and the pointers to their successors. Level 2: successors, made
    monotone over all contexts by adding the context's place times the number of words, and one
    16-bit code each. All arrays lie in one file that is mapped, not read.
    """

    @staticmethod
    def write(path: str, context: np.ndarray, word: np.ndarray, codes: np.ndarray) -> list:
        """Write distinct (context, word) pairs sorted by both; returns what ``open`` needs."""
        contexts, starts = np.unique(context, return_index=True)
        words = int(word.max(initial=0)) + 1
        place = np.repeat(np.arange(len(contexts)), np.diff([*starts, len(context)]))
        limit = int(contexts[-1]) + 1 if len(contexts) else 1
        levels = [
            (contexts, limit),
            (np.append(starts, len(context)), len(context) + 1),
            (place * words + word, max(1, len(contexts) * words)),
        ]
        layout: list = [words, limit]
        with open(path, "wb") as out:
            def put(array: np.ndarray) -> tuple:
                out.write(b"\0" * (-out.tell() % 8))
                where = (out.tell(), array.dtype.str, len(array))
                out.write(array.tobytes())
                return where

            for values, universe in levels:
                n, width, *arrays = EliasFano.pack(values, universe)
                layout.append((n, width, [put(a) for a in arrays]))
            layout.append(put(codes.astype("<u2")))
        return layout

    def __init__(self, path: str, layout: list):
        mapped = np.memmap(path, dtype=np.uint8, mode="r")

        def view(where: tuple) -> np.ndarray:
            start, kind, length = where
            return mapped[start : start + length * np.dtype(kind).itemsize].view(kind)

        self.words, self.limit = layout[:2]
        self.contexts, self.pointers, self.successors = (
            EliasFano(n, width, *map(view, arrays)) for n, width, arrays in layout[2:5]
        )
        self.codes = view(layout[5])

    def find(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Place of each pair among the successors, -1 where it is not in the trie."""
        out = np.full(len(context), -1, dtype=np.int64)
        if not self.contexts.size:
            return out
        # a context is looked up once, its successors are searched relative to its place
        asked, which = np.unique(context, return_inverse=True)
        place = np.full(len(asked), -1, dtype=np.int64)
        near = np.flatnonzero(asked < self.limit)
        found, equal = self.contexts.successor(asked[near])
        place[near[equal]] = found[equal]
        first, last = self.pointers.get(np.maximum(place, 0)), self.pointers.get(np.maximum(place, 0) + 1)
        at = np.flatnonzero((place[which] >= 0) & (word < self.words))
        mine = which[at]
        found, equal = self.successors.successor(place[mine] * self.words + word[at])
        equal &= (found >= first[mine]) & (found < last[mine])
        out[at[equal]] = found[equal]
        return out
