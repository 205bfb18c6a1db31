"""The corpus pipeline: four stages from raw documents to token ids.

Each stage takes (spark, docs, sf_dir); all but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lamina.llm import byte_bpe, fair_mix, simhash_tiles, toxicity
from lamina.llm.common import Staged, ship
from lamina.suite import table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores below one half; it learns from the labelled ones here."""
    ship(spark)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model, output="__toxicity")
    return scored.where("__toxicity < 0.5").select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: 3-word shingles, at most 3 differing bits."""
    ship(spark)
    return simhash_tiles.deduplicate(docs, shingle=3, radius=3)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: weights 5, 2, 1 in turn, 150 % of all words."""
    return fair_mix.materialise(docs)


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document of the mix: ids of the whole text condensed, and the round trip's digest."""
    ship(spark)
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return byte_bpe.digests(docs, "doc_id", "text", ranks, public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("source_mix", mix_sources),
    ("byte_bpe", to_tokens),
]

#: SimHash components, the classifier and BPE are not expressible in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is a written table that the next stage reads."""
    docs = table(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES[:-1]:
        written = Staged(stage(spark, docs, sf_dir), f"pipeline-{name}", "zstd")
        if before:
            before.drop()
        docs, before = written.df, written
    return STAGES[-1][1](spark, docs, sf_dir)
