"""Stretches of words that repeat with a period, found with string synchronising sets.

A run is a stretch of consecutive words with smallest period q and at least 3q words that neither
neighbour extends. Periods below ``DIRECT`` are found by comparing the words q apart. Longer ones
are found octave by octave, in two parts each: periods from P up to 4/3 P or 3/2 P share one set of
synchronising positions. A position belongs to it when the least hash of the P words that start at
one of the next P/2 + 1 positions stands at the first or the last of them. Membership depends on
the next 3/2 P words alone, so copies of a passage choose the same positions. Positions whose P
words have a period up to P/3 choose nothing (all would); they lie in runs of smaller periods, which
are known by then. Every other stretch of P + 2 positions has one that was chosen, so a run of
period p has a chosen position whose next position with an equal context of 3/2 P words is p words
later: such neighbours propose their distance as a period. Each proposal is extended word by word
to both sides, and kept if it is long enough and its period is the smallest.

The texts of a slice are searched together, with a border between them that equals nothing. Chosen
positions thin out as P grows, proposals inside a known stretch are skipped, and texts shorter than
3P leave, so a text of n words costs about n log n steps, all of them array operations.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import slices

#: Periods below this are found by direct comparison.
DIRECT = 8

#: A run has at least this many periods.
PERIODS = 3

_LAST = np.uint64(0xFFFFFFFFFFFFFFFF)
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


def _mixed(values: np.ndarray) -> np.ndarray:
    """64-bit hashes of 64-bit values."""
    values = (values ^ (values >> np.uint64(30))) * _ODD[1]
    values = (values ^ (values >> np.uint64(27))) * _ODD[2]
    return values ^ (values >> np.uint64(31))


def _ahead(values: np.ndarray, by: int, filler) -> np.ndarray:
    """Each position's value ``by`` positions later."""
    return np.concatenate([values[by:], np.full(min(by, len(values)), filler, values.dtype)])


def _joined(left: np.ndarray, right: np.ndarray, by: int) -> np.ndarray:
    """Hashes of windows from those of a left part and of a part ``by`` positions later."""
    return _mixed(left * _ODD[0] + _ahead(right, by, 0))


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of ``width`` positions from each one on."""
    held = 1
    while held * 2 <= width:
        values = np.minimum(values, _ahead(values, held, _LAST))
        held *= 2
    return np.minimum(values, _ahead(values, width - held, _LAST)) if held < width else values


def _extent(words: np.ndarray, at: int, period: int) -> tuple[int, int]:
    """First and last-but-one position of the longest stretch of this period that holds ``at``.

    The words at ``at`` and ``period`` words later are equal.
    """
    size, ends = len(words), [at, at]
    for side in (0, 1):
        step = 64
        while True:
            place = ends[side]
            if side:
                here = words[place : min(place + step, size - period)]
                there = words[place + period : place + period + len(here)]
            else:
                first = max(place - step, 0)
                here, there = words[first:place][::-1], words[first + period : place + period][::-1]
            unlike = np.flatnonzero(here != there)
            moved = int(unlike[0]) if len(unlike) else len(here)
            ends[side] += moved if side else -moved
            if len(unlike) or not len(here):
                break
            step *= 2
    return ends[0], ends[1] + period


def _primitive(words: np.ndarray, start: int, period: int) -> bool:
    """Whether a stretch of this period, twice as long at least, has no smaller one that divides it."""
    rest, prime = period, 2
    while rest > 1:
        if rest % prime:
            prime = prime + 1 if prime * prime <= rest else rest
            continue
        while rest % prime == 0:
            rest //= prime
        part = period // prime
        if (words[start : start + period] == words[start + part : start + part + period]).all():
            return False
    return True


def _direct(words: np.ndarray, period: int) -> Iterator[tuple[int, int]]:
    """Runs of one period, as (start, end), by comparing all words that are ``period`` apart."""
    equal = np.flatnonzero(words[:-period] == words[period:])
    if not len(equal):
        return
    breaks = np.flatnonzero(np.diff(equal) != 1)
    firsts, lasts = equal[np.concatenate([[0], breaks + 1])], equal[np.concatenate([breaks, [len(equal) - 1]])]
    long = lasts - firsts + 1 >= (PERIODS - 1) * period
    for start, last in zip(firsts[long].tolist(), lasts[long].tolist()):
        if _primitive(words, start, period):
            yield start, last + 1 + period


def _proposals(hashes: np.ndarray, context: np.ndarray, barred: np.ndarray, size: int, top: int):
    """(distance, position) where chosen neighbours of equal context are ``size`` to ``top`` - 1 apart."""
    window = size // 2
    hashes = np.where(barred, _LAST, hashes)
    least = _least(hashes, window + 1)
    chosen = np.flatnonzero(((least == hashes) | (least == _ahead(hashes, window, _LAST))) & (least != _LAST))
    near = context[chosen]
    order = np.argsort(near, kind="stable")
    chosen, near = chosen[order], near[order]
    apart = np.diff(chosen)
    fits = np.flatnonzero((near[1:] == near[:-1]) & (apart >= size) & (apart < top))
    found = np.stack([apart[fits], chosen[fits]])
    return found[:, np.lexsort(found[::-1])].T.tolist()


def find_runs(texts: list[np.ndarray]) -> list[list[tuple[int, int, int]]]:
    """For each text of word numbers (0 or more), all its runs as (start, length, period), in order."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    held = np.flatnonzero(sizes >= PERIODS)
    if not len(held):
        return found
    # each text is followed by a border, a number of its own below zero
    words = np.concatenate([part for n in held.tolist() for part in (texts[n], [-1 - n])]).astype(np.int64)
    begins = np.cumsum(sizes[held] + 1) - sizes[held] - 1

    def add(start: int, end: int, period: int) -> None:
        n = int(np.searchsorted(begins, start, "right")) - 1
        found[held[n]].append((start - int(begins[n]), end - start, period))

    for period in range(1, DIRECT):
        for start, end in _direct(words, period):
            add(start, end, period)

    powers = {1: _mixed(words.astype(np.uint64))}
    width = 1
    for size, top in _scales(int(sizes.max()) // PERIODS):
        stay = sizes[held] >= PERIODS * size
        if not stay.all():
            mask = np.repeat(stay, sizes[held] + 1)
            words, powers = words[mask], {k: v[mask] for k, v in powers.items()}
            held = held[stay]
            begins = np.cumsum(sizes[held] + 1) - sizes[held] - 1
        while width * 2 <= size:
            powers[width * 2] = _joined(powers[width], powers[width], width)
            powers.pop(width // 2, None)
            width *= 2
        if size == width:
            hashes = powers[width]
            context = _joined(hashes, powers[width // 2], width)
        else:
            hashes = _joined(powers[width], powers[width // 2], width)
            context = _joined(hashes, hashes, size // 2)
        # positions whose words have a small period: they start in a run of it, as long as the window
        edges = np.zeros(len(words) + 1, dtype=np.int64)
        for begin, n in zip(begins.tolist(), held.tolist()):
            for start, length, period in found[n]:
                if PERIODS * period <= size <= length:
                    edges[begin + start] += 1
                    edges[begin + start + length - size + 1] -= 1
        barred = np.cumsum(edges[:-1]) > 0
        before, until = 0, 0
        for period, at in _proposals(hashes, context, barred, size, top):
            if period == before and at + period < until:
                continue  # within the stretch just seen
            if words[at] != words[at + period]:
                continue  # unequal contexts of one hash
            start, until = _extent(words, at, period)
            before = period
            if until - start >= PERIODS * period and _primitive(words, start, period):
                add(start, until, period)
    for runs in found:
        runs.sort(key=lambda run: (run[0], run[2]))
    return found


def _scales(longest: int) -> Iterator[tuple[int, int]]:
    """(P, end) of the ranges of periods up to ``longest``: powers of two and half as much again."""
    size = DIRECT
    while size <= longest:
        yield size, size * 3 // 2
        if size * 3 // 2 <= longest:
            yield size * 3 // 2, size * 2
        size *= 2


class _Numbers(dict):
    """Numbers words as they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def _split(texts: list[str | None]) -> tuple[list[list[bytes]], list[np.ndarray]]:
    numbers = _Numbers()
    words = [t.encode("utf-8").split() if t else [] for t in texts]
    return words, [np.fromiter(map(numbers.__getitem__, w), np.int64, len(w)) for w in words]


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> str:
    """The words that no run holds after its first period, joined by a blank."""
    if runs:
        kept = np.ones(len(words), dtype=bool)
        for start, length, period in runs:
            kept[start + period : start + length] = False
        words = [words[i] for i in np.flatnonzero(kept).tolist()]
    return b" ".join(words).decode("utf-8")


def repeats(docs: DataFrame, text_column: str, keep: list[str], least: int = 24) -> DataFrame:
    """``docs[keep]`` with ``n_words``, ``runs`` (start, length, period) and ``collapsed`` text.

    Words are what white space of ASCII separates (`[^\\x20\\x09-\\x0D]+`). Runs have ``least`` words and
    three periods at least and come by start, then period; runs that overlap are all given. A
    null, empty or blank text has no words, no runs and an empty collapsed text; a text of any length is
    searched whole. Repeated rows stay, an empty table gives an empty one, other columns are not read.
    The three added names may not be kept ones.
    """
    added = ["n_words", "runs", "collapsed"]
    if set(added) & set(keep):
        raise ValueError(f"a kept column may not be called {' or '.join(added)}")
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 0):
                words, numbers = _split(part.column(0).to_pylist())
                long = [[r for r in runs if r[1] >= least] for runs in find_runs(numbers)]
                named = [[dict(zip(("start", "length", "period"), r)) for r in runs] for runs in long]
                columns = [
                    pa.array([len(w) for w in words], pa.int64()),
                    pa.array(named, kind),
                    pa.array([collapsed(w, r) for w, r in zip(words, long)], pa.string()),
                ]
                yield pa.RecordBatch.from_arrays([*part.columns[1:], *columns], [*keep, *added])

    kinds = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep]
    kinds += ["n_words bigint", "runs array<struct<start:bigint,length:bigint,period:bigint>>", "collapsed string"]
    source = docs.select(docs[text_column].alias("__text"), *[docs[c] for c in keep])
    return source.mapInArrow(run, ", ".join(kinds))


def strongest(runs):
    """Of an array of runs by start and period, the one with most periods; ties: the first of them."""
    empty = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")

    def better(best, run):
        more = run["length"] * best["period"] > best["length"] * run["period"]
        return F.when(best.isNull() | more, run).otherwise(best)

    return F.reduce(runs, empty, better)


def digests(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Runs condensed: id, n_runs, the strongest run and digests of all runs and of the collapsed text."""
    found = repeats(docs, text_column, [id_column]).withColumn("best", strongest("runs"))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.array_join(F.transform(lines, lambda line: F.concat(line, F.lit("\n"))), "")
    return found.select(
        id_column,
        F.size("runs").cast("bigint").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
