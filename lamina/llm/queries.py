"""The registered queries of this subpackage, with SQL where SQL can express the operator."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.llm import (
    byte_bpe,
    fair_mix,
    license_scan,
    merkle_manifest,
    ngram_lm,
    periodic_runs,
    pivot_dedup,
    prefix_bpe,
    simhash_tiles,
    toxicity,
    training_order,
    url_templates,
    vptree,
)
from lamina.llm.common import id_remainder, ship
from lamina.session import scratch
from lamina.suite import Suite, table

suite = Suite()

#: Vectors with a direction; embeddings of the tables are lists of 32-bit floats.
USABLE = """
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
"""


@suite.query()
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id",
        (id_remainder("doc_id", 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@suite.query(f"""
    WITH RECURSIVE usable AS ({USABLE} AND label IS NOT NULL),
    links AS (
        SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
        ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
        WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
    reached(a, b) AS (
        SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a),
    lowest AS (SELECT a, min(b) AS low FROM reached GROUP BY a),
    degrees AS (SELECT a, count(*) AS n FROM links GROUP BY a)
    SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(low, vec_id)) AS component_id,
           vec_id <= coalesce(low, vec_id) AS kept
    FROM embeddings LEFT JOIN degrees d ON d.a = vec_id LEFT JOIN lowest l ON l.a = vec_id
""")
def op2_pivot_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return pivot_dedup.near_duplicates(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


@suite.query()
def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = table(spark, sf_dir, "documents")
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return byte_bpe.digests(docs, "doc_id", "text", ranks, public_tokenizers.PATTERN)


@suite.query()
def op4_ngram_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return ngram_lm.score(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@suite.query(f"""
    SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
        SELECT q.vec_id AS query_id, v.vec_id, list_inner_product(q.e, v.e) AS score,
               row_number() OVER (PARTITION BY q.vec_id ORDER BY list_inner_product(q.e, v.e) DESC, v.vec_id) AS rank
        FROM ({USABLE}) q JOIN ({USABLE}) v ON q.vec_id <> v.vec_id AND len(q.e) = len(v.e)
        WHERE q.vec_id % 20 = 0)
    WHERE rank <= 20
""")
def op5_vptree(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return vptree.search(table(spark, sf_dir, "embeddings"), k=20, every=20, factor=1.0)


@suite.query()
def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    found = license_scan.scan(table(spark, sf_dir, "documents"))
    return license_scan.summary(found, whole=True).withColumnRenamed("id", "doc_id")


#: Tokens of a sequence, sequences of a shard, the key of the order, and the end token (also the filler).
LENGTH, PER_SHARD, KEY, END = 512, 4096, 20260, 50256


@suite.query()
def op7_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the shards and reads every record back from them, with the documents it holds."""
    ship(spark)
    docs = table(spark, sf_dir, "documents")
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    records = training_order.pack_texts(
        docs, "doc_id", "text", ranks, public_tokenizers.PATTERN, LENGTH, END, END
    )
    path = scratch(spark, "training-order")
    training_order.write(records, path, PER_SHARD, KEY)
    found = training_order.read(spark, path, LENGTH, PER_SHARD).select(
        "slot", "shard", F.size("tokens").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join("tokens", " "), 256).alias("tokens_sha256"),
    )
    held = training_order.segments(spark, path).select(
        "slot", F.col("segments.id").alias("doc_ids"), F.element_at("segments.offset", 1).alias("first_offset")
    )
    return found.join(held, "slot")


@suite.query()
def op8_simhash_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    found = simhash_tiles.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), simhash_tiles.hex_fingerprint("fp").alias("fingerprint"), "component_id"
    )


@suite.query(
    r"""
    WITH docs AS (
        SELECT doc_id, source, md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '~' || coalesce(text, ''))) AS key,
            CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
        FROM documents),
    sizes AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM docs GROUP BY source),
    weighted AS (
        SELECT source, source_size, 2.0::DOUBLE * source_size AS cap,
            CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
                WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS weight
        FROM sizes),
    levels AS (
        SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()
                - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
        FROM weighted WINDOW o AS (ORDER BY cap / weight, source NULLS LAST)),
    aims AS (
        SELECT source, source_size, least(cap, weight
            * max(CASE WHEN level <= cap / weight THEN level END) OVER ()) AS target FROM levels),
    queued AS (
        SELECT d.*, a.source_size, a.target, sum(size) OVER (
            PARTITION BY d.source ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) AS through
        FROM docs d JOIN aims a ON d.source IS NOT DISTINCT FROM a.source),
    items AS (
        SELECT q.*, e.epoch, CAST(through + e.epoch * source_size AS DOUBLE) / target AS finish
        FROM queued q, (VALUES (0), (1)) e(epoch) WHERE target > 0),
    sorted AS (
        SELECT *, sum(size) OVER (ORDER BY finish, epoch, source NULLS LAST, key, doc_id, size
            ROWS UNBOUNDED PRECEDING) AS run FROM items),
    chosen AS (
        SELECT doc_id, key, through, count(*) AS copies FROM sorted
        WHERE run <= (SELECT 1.5 * sum(source_size) FROM sizes) GROUP BY ALL)
    SELECT q.doc_id, q.size, q.source_size, q.target, CAST(q.size * coalesce(c.copies, 0) AS BIGINT) AS taken
    FROM queued q LEFT JOIN chosen c ON q.doc_id IS NOT DISTINCT FROM c.doc_id
        AND q.key = c.key AND q.through = c.through
    """
)
def op9_fair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fair_mix.mix(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


#: Rules of the URL filter, as (verdict, host and path).
URL_RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]


@suite.query()
def op10_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    found = url_templates.judge(table(spark, sf_dir, "pages"), URL_RULES)
    return found.select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict", "template", "purity")


@suite.query()
def op11_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return prefix_bpe.digests(table(spark, sf_dir, "documents"), "doc_id", "text", public_tokenizers.path("word_bpe_49k.json"))


def planted_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with a tenth of the texts made periodic from some word on.

    With h the checksum of the id and g = h // 10, texts with h % 10 = 0 and n > 0 words repeat from word
    a = g % n on, with period p = 1 + (n - a) // (3 + g % 8), up to their n words.
    """
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    words = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    docs = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, words).alias("words"))
    n, g = F.size("words"), F.floor(F.col("h") / 10)
    docs = docs.withColumns({"n": n, "a": (g % n).cast("int"), "g": g})
    docs = docs.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    times = F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")
    period = F.slice("words", F.col("a") + 1, F.col("p"))
    text = F.concat(F.slice("words", F.lit(1), F.col("a")), F.flatten(F.array_repeat(period, times)))
    text = F.array_join(F.slice(text, F.lit(1), F.col("n")), " ")
    return docs.select("doc_id", F.when(F.col("n") > 0, text).otherwise(F.col("text")).alias("text"))


@suite.query()
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return periodic_runs.digests(planted_repeats(table(spark, sf_dir, "documents")), "doc_id", "text")


@suite.query()
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proofs of all documents; where 7 divides the id's checksum, n_chars of the verified copy is one more."""
    ship(spark)
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    altered = ["doc_id", "source", "lang", F.col("n_chars") + 1, "text"]
    copy = F.when(id_remainder("doc_id", 7) == 0, merkle_manifest.leaf(altered))
    found = merkle_manifest.manifest(table(spark, sf_dir, "documents"), "doc_id", "lang", columns, copy)
    return found.select(
        "doc_id", "leaf", "subroot", "root",
        F.sha2(F.col("siblings").cast("binary"), 256).alias("proof_sha256"),
        "folded_root", "verified",
    )
