"""Toxicity scores from a counterfactual-regularised classifier.

A logistic model over the words of a text and the beginnings of its words. Labelled texts
that mention a group are scored a second time with the group terms swapped for others of the
same kind; the squared change of the score is part of the loss. What a text says about a group
then weighs the same whichever group it is, and neutral mentions gain no weight of their own.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import Staged, id_remainder, slices

#: Neutral terms for groups of people, by kind and language; each is swapped for the next.
IDENTITY_TERMS = (
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "african", "european"),
    ("gay", "straight", "lesbian", "bisexual", "heterosexual", "queer"),
    ("woman", "man"),
    ("women", "men"),
    ("transgender", "cisgender"),
    ("immigrant", "citizen", "refugee"),
    ("immigrants", "citizens", "refugees"),
    ("disabled", "deaf", "blind"),
    ("christ", "muslim", "jude", "hindu", "buddhist", "atheist"),
    ("frau", "mann"),
    ("frauen", "männer"),
    ("schwul", "lesbisch", "hetero"),
    ("chrétien", "musulman", "juif", "hindou", "bouddhiste", "athée"),
    ("femme", "homme"),
    ("femmes", "hommes"),
    ("cristiano", "musulmán", "judío", "hindú", "budista", "ateo"),
    ("mujer", "hombre"),
    ("mujeres", "hombres"),
)
#: Characters of a word's beginning that make a feature of their own.
PREFIX = 4
_words = re.compile(r"\w+").findall


def _swaps() -> dict[str, str]:
    swaps: dict[str, str] = {}
    for terms in IDENTITY_TERMS:
        for term, other in zip(terms, (*terms[1:], terms[0])):
            swaps.setdefault(term, other)
    return swaps


def features(words: set[str]) -> set[str]:
    """Features of a text's distinct lower-case words: the words, and ``beginning*``."""
    return words | {w[:PREFIX] + "*" for w in words}


def distinct_words(text: str | None) -> set[str]:
    return set(_words((text or "").lower()))


@dataclass(frozen=True)
class Model:
    """Weights by feature, and the score of a text without any of them (as log odds)."""

    weights: dict[str, float]
    bias: float

    def score(self, text: str | None) -> float:
        found = features(distinct_words(text)) & self.weights.keys()
        # sorted, so that sums do not depend on the order of a set
        return float(1 / (1 + np.exp(-np.clip(self.bias + sum(self.weights[f] for f in sorted(found)), -50, 50))))


def _counts(rows: DataFrame) -> DataFrame:
    """(feature, toxic, clean): texts of either label with the feature, summed per task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = (Counter(), Counter())
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sums[label].update(features(distinct_words(text)))
            names = list(sums[0].keys() | sums[1].keys())
            yield pa.RecordBatch.from_pydict(
                {"feature": names, "toxic": [sums[1][n] for n in names], "clean": [sums[0][n] for n in names]}
            )

    parts = rows.select("text", "label").mapInArrow(run, "feature string, toxic bigint, clean bigint")
    return parts.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _telling(counts: DataFrame, toxic: int, clean: int, size: int) -> list[str]:
    """The ``size`` features that tell the labels apart best, by the likelihood ratio."""

    def term(part, expected):
        return F.when(part > 0, part * F.log(part / expected)).otherwise(0.0)

    whole = float(toxic + clean)
    have = (F.col("toxic") + F.col("clean")).cast("double")
    ratio = (
        term(F.col("toxic"), have * toxic / whole)
        + term(F.col("clean"), have * clean / whole)
        + term(toxic - F.col("toxic"), (whole - have) * toxic / whole)
        + term(clean - F.col("clean"), (whole - have) * clean / whole)
    )
    best = counts.where("toxic + clean >= 2").select("feature", F.round(ratio, 6).alias("ratio"))
    best = best.orderBy(F.desc("ratio"), "feature").limit(size)
    return [r[0] for r in best.collect()]


def _train(rows: list[np.ndarray], swapped: list[np.ndarray | None], labels: np.ndarray, size: int,
           penalty: float, ridge: float, steps: int) -> tuple[np.ndarray, float]:
    """Minimise log loss + penalty * squared score change + ridge by full-batch Adam."""
    pairs = [i for i, s in enumerate(swapped) if s is not None]

    def stacked(parts):
        lengths = np.array([len(p) for p in parts], dtype=np.int64)
        return np.concatenate([*parts, np.empty(0, np.int64)]).astype(np.int64), np.repeat(np.arange(len(parts)), lengths)

    index, row = stacked(rows)
    index_a, row_a = stacked([rows[i] for i in pairs])
    index_b, row_b = stacked([swapped[i] for i in pairs])
    n, weights, bias = len(rows), np.zeros(size), 0.0
    m, v = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, steps + 1):
        z = np.bincount(row, weights=weights[index], minlength=n) + bias
        error = (1 / (1 + np.exp(-np.clip(z, -50, 50))) - labels) / n
        slope = np.bincount(index, weights=error[row], minlength=size) + ridge * weights
        if pairs:
            change = np.bincount(row_a, weights=weights[index_a], minlength=len(pairs))
            change -= np.bincount(row_b, weights=weights[index_b], minlength=len(pairs))
            change *= 2 * penalty / len(pairs)
            slope += np.bincount(index_a, weights=change[row_a], minlength=size)
            slope -= np.bincount(index_b, weights=change[row_b], minlength=size)
        slope = np.append(slope, error.sum())
        m, v = 0.9 * m + 0.1 * slope, 0.99 * v + 0.01 * slope**2
        move = 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        weights, bias = weights - move[:-1], bias - move[-1]
    return weights, float(bias)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
    per_class: int = 4096,
    vocabulary: int = 2048,
    penalty: float = 1.0,
    ridge: float = 1e-4,
    steps: int = 300,
    folds: int = 5,
) -> Model:
    """Learn from labelled texts whose id's crc32 modulo ``folds`` is not 0.

    Of each label at most ``per_class`` rows are used, those with the smallest hash of the id:
    the bound that lets the driver hold the sparse rows (``per_class`` * 2 * ``vocabulary``
    at most). Null ids and null labels teach nothing; of several labels of one id the largest
    counts, of several texts the smallest. With labels of one kind only, or none, the model
    gives every text the smoothed share of toxic labels.
    """
    known = labels.where(labels[id_column].isNotNull() & labels[label_column].isin(0, 1))
    known = known.select(labels[id_column].alias("id"), labels[label_column].cast("int").alias("label"))
    known = known.groupBy("id").agg(F.max("label").alias("label")).where(id_remainder("id", folds) != 0)
    known = known.withColumn("order", F.xxhash64("id"))
    known = Staged(known, "labels", light=True)
    picked = [known.df.where(F.col("label") == k).orderBy("order", "id").limit(per_class) for k in (0, 1)]
    picked = Staged(picked[0].unionByName(picked[1]).select("id", "label"), "labels", light=True)
    known.drop()
    texts = docs.select(docs[id_column].alias("id"), docs[text_column].alias("text"))
    rows = texts.join(F.broadcast(picked.df), "id").groupBy("id", "label").agg(F.min("text").alias("text"))
    rows = Staged(rows, "labelled", "snappy", light=True)
    n = {r[0]: r[1] for r in rows.df.groupBy("label").count().collect()}
    toxic, clean = n.get(1, 0), n.get(0, 0)
    if not toxic or not clean:
        return Model({}, float(np.log((toxic + 1) / (clean + 1))))
    swaps = _swaps()
    names = sorted({*_telling(_counts(rows.df), toxic, clean, vocabulary), *features(set(swaps))})
    at = {name: i for i, name in enumerate(names)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, other = [], []
            for text in batch.column(0).to_pylist():
                words = distinct_words(text)
                found.append(sorted(at[f] for f in features(words) & at.keys()))
                swapped = {swaps.get(w, w) for w in words}
                other.append(None if swapped == words else sorted(at[f] for f in features(swapped) & at.keys()))
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, kind), pa.array(other, kind), batch.column(1), batch.column(2)],
                ["found", "swapped", "label", "id"],
            )

    kind = docs.schema[id_column].dataType.simpleString()
    sparse = rows.df.select("text", "label", "id").mapInArrow(
        run, f"found array<int>, swapped array<int>, label int, id {kind}"
    )
    sparse = sorted(sparse.collect(), key=lambda r: r["id"])
    weights, bias = _train(
        [np.array(r["found"], dtype=np.int64) for r in sparse],
        [None if r["swapped"] is None else np.array(r["swapped"], dtype=np.int64) for r in sparse],
        np.array([r["label"] for r in sparse], dtype=float), len(names), penalty, ridge, steps,
    )
    rows.drop()
    picked.drop()
    return Model(dict(zip(names, weights.tolist())), bias)


def score(docs: DataFrame, model: Model, text_column: str = "text", output: str = "score") -> DataFrame:
    """``docs`` with the probability that the text is toxic (double, 0 to 1) in column ``output``.

    Reads the whole text and nothing else; null and empty texts get the score of no evidence.
    ``output`` may not be a column of ``docs``. Repeated rows get equal scores.
    """
    names = docs.columns
    if output in names:
        raise ValueError(f"there is a column {output} already")
    at = names.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, at):
                found = pa.array([model.score(t) for t in part.column(at).to_pylist()], pa.float64())
                yield pa.RecordBatch.from_arrays([*part.columns, found], [*names, output])

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields]
    return docs.mapInArrow(run, ", ".join([*kinds, f"`{output}` double"]))
