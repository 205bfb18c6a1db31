"""Prefix BPE, periodic runs and Merkle manifests against the library and brute force."""

import hashlib
import math
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lamina.llm import merkle_manifest, periodic_runs, prefix_bpe, queries

SF = "/root/testdata/sf0.01"
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    (1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "a b c d"), (5, "a b c d"), (None, "the the the"),
    (6, "word " * 40_000), (7, "x" * 200_000), (8, "naïve ΣΊΓΜΑ 中文 \U0001f600 \x1c\x85 ẹ́"), (9, "İstanbul ǅ"),
    (10, "a <|endoftext|>B<|startoftext|>  it's 12,5"), (14, "u v w " * 9), (25, "p q r s t\n" * 12),
]


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def checksum(key):
    return zlib.crc32(b"" if key is None else str(key).encode())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORD_BPE)


PIECES = ["<|endoftext|>", "<|startoftext|>", "<|endof", "thing", "ing", "aaaa", "haha", " ", "Σ", "İ", "é", "́", "'LL"]


@settings(max_examples=400, deadline=None)
@given(
    st.text(max_size=40)
    | st.text(alphabet="abcdeot 's", max_size=60)
    | st.lists(st.sampled_from(PIECES), max_size=12).map("".join)
    | st.integers(1, 80).map(lambda n: "a" * n + "ha" * n)
)
def test_words_encode_as_the_library_does(library, text):
    text = text.encode("utf-8", "replace").decode()
    model = prefix_bpe.encoder(WORD_BPE)
    want = library.encode(text, add_special_tokens=False).ids
    assert model.encode(text).tolist() == want
    assert prefix_bpe.decoded(want, model.vocabulary.names) == library.decode(want, skip_special_tokens=False)


def test_every_prefix_ends_with_the_last_token_of_its_encoding():
    model = prefix_bpe.encoder(WORD_BPE)
    for word in ("internationalisation", "aaaaaaaaaaa", "thethethe", "xqzjinging"):
        last = model.last_tokens(word)
        for end in range(1, len(word) + 1):
            assert last[end] == model.vocabulary.merged(word[:end])[-1]


def digests_of(library, key, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return key, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))


def test_prefix_bpe_on_odd_rows_and_an_empty_table(spark, documents, library):
    found = prefix_bpe.digests(documents(ODD), "doc_id", "text", WORD_BPE)
    assert sorted(map(tuple, found.collect()), key=str) == sorted((digests_of(library, *r) for r in ODD), key=str)
    assert prefix_bpe.digests(documents(ODD).limit(0), "doc_id", "text", WORD_BPE).collect() == []
    with pytest.raises(ValueError, match="ids"):
        prefix_bpe.encode(documents(ODD), "text", WORD_BPE, ["ids"])


def test_prefix_bpe_decodes_what_it_encoded(spark, documents, library):
    tokens = prefix_bpe.encode(documents(ODD), "text", WORD_BPE, ["doc_id", "key"])
    back = prefix_bpe.decode(tokens, "ids", WORD_BPE).collect()
    assert all(r.decoded == library.decode(r.ids, skip_special_tokens=False) and r.key == "k" for r in back)
    unknown = spark.createDataFrame([([1, 60_000],)], "ids array<int>")
    with pytest.raises(Exception, match="outside the vocabulary"):
        prefix_bpe.decode(unknown, "ids", WORD_BPE).collect()


def test_prefix_bpe_query_against_the_library(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = sorted(digests_of(library, *r) for r in docs)
    assert sorted(map(tuple, queries.op11_prefix_bpe(spark, SF).collect())) == want


def brute_runs(words):
    """All runs by comparing every word with the one each period later."""
    found, n = [], len(words)
    for period in range(1, n // 3 + 1):
        at = 0
        while at + period < n:
            start = at
            while at + period < n and words[at] == words[at + period]:
                at += 1
            part = words[start : at + period]
            if len(part) >= 3 * period and not any(part[d:] == part[:-d] for d in range(1, period)):
                found.append((start, len(part), period))
            at = max(at, start + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def fibonacci(n):
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


BLOCKS = st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=70), st.integers(1, 7), st.lists(st.integers(3, 5), max_size=3))


@settings(max_examples=200, deadline=None)
@given(
    st.lists(
        st.lists(BLOCKS, max_size=4).map(lambda found: [w for block, n, rest in found for w in block * n + rest])
        | st.lists(st.integers(0, 1), max_size=200),
        max_size=4,
    )
)
def test_runs_are_those_of_brute_force(texts):
    found = periodic_runs.find_runs([np.array(t, dtype=np.int64) for t in texts])
    assert found == [brute_runs(t) for t in texts]


def test_runs_within_runs_and_very_long_ones():
    nested = ([0] * 30 + [1]) * 9 + [2] + ([3, 4] * 20 + [5, 6, 7]) * 4
    for words in (nested, fibonacci(700), [0] * 500, list(range(97)) * 5, (([1] * 8 + [2]) * 7 + [3]) * 5):
        assert periodic_runs.find_runs([np.array(words)]) == [brute_runs(words)]
    long = np.tile(np.arange(33_333), 31)[:1_000_000]
    assert periodic_runs.find_runs([long]) == [[(0, 1_000_000, 33_333)]]


def run_row(key, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = checksum(key), len(words)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = [r for r in brute_runs(words) if r[1] >= 24]
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2])) if runs else None
    columns = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    return key, len(runs), *columns, sha(lines), sha(" ".join(w for i, w in enumerate(words) if i not in gone))


def test_runs_of_odd_rows_and_an_empty_table(spark, documents):
    rows = [r for r in ODD if r[0] not in (6,)]
    found = periodic_runs.digests(queries.planted_repeats(documents(rows)), "doc_id", "text").collect()
    assert sorted(map(tuple, found), key=str) == sorted((run_row(*r) for r in rows), key=str)
    assert periodic_runs.digests(documents(rows).limit(0), "doc_id", "text").collect() == []
    with pytest.raises(ValueError, match="runs"):
        periodic_runs.repeats(documents(rows).withColumn("runs", F.lit(1)), "text", ["runs"])
    whole = periodic_runs.repeats(documents([(6, "word " * 40_000)]), "text", ["doc_id", "size"]).first()
    assert whole.runs[0].asDict() == {"start": 0, "length": 40_000, "period": 1}
    assert (whole.collapsed, whole.n_words, whole.size) == ("word", 40_000, 2)


def test_runs_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    short = [r for r in docs if len((r.text or "").split()) <= 1_500]
    assert len(short) > 0.9 * len(docs)
    want = {r.doc_id: run_row(*r) for r in short}
    found = {r.doc_id: tuple(r) for r in queries.op12_periodic_runs(spark, SF).collect()}
    assert len(found) == len(docs) and {k: found[k] for k in want} == want


def plain_leaf(values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_tree(nodes):
    """(root, proof of each node as siblings with None for none, and sides) of a list of digests."""
    proofs, places, layer = [[] for _ in nodes], list(range(len(nodes))), nodes
    while len(layer) > 1:
        for proof, at in zip(proofs, places):
            proof.append((layer[at ^ 1] if at ^ 1 < len(layer) else None, (at ^ 1) < at))
        layer = [sha("".join(layer[i : i + 2])) for i in range(0, len(layer), 2)]
        places = [at // 2 for at in places]
    return (layer or [None])[0], proofs


def plain_fold(node, proof):
    for sibling, left in proof:
        node = sha(node if sibling is None else sibling + node if left else node + sibling)
    return node


def plain_manifest(rows):
    """Rows of the query for (doc_id, source, lang, n_chars, text), by definition."""
    out, subroots = [], {}
    for lang in sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode())):
        held = [r for r in rows if r[2] == lang]
        held = sorted(((plain_leaf(r), r) for r in held), key=lambda p: (p[1][0] is not None, p[1][0] or 0, p[0]))
        subroots[lang] = plain_tree([leaf for leaf, _ in held])[0], held
    root, above = plain_tree([s for s, _ in subroots.values()])
    for ahead, (subroot, held) in zip(above, subroots.values()):
        for proof, (leaf, r) in zip(plain_tree([x for x, _ in held])[1], held):
            shown = r
            if checksum(r[0]) % 7 == 0 and r[3] is not None:
                shown = (*r[:3], r[3] + 1, r[4])
            folded = plain_fold(plain_leaf(shown), proof + ahead)
            siblings = "".join(s for s, _ in proof + ahead if s is not None)
            out.append((r[0], leaf, subroot, root, sha(siblings), folded, folded == root))
    return sorted(out, key=str)


COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def manifest_rows(df, bits):
    copy = F.when(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 7 == 0, merkle_manifest.leaf(
        ["doc_id", "source", "lang", F.col("n_chars") + 1, "text"]))
    found = merkle_manifest.manifest(df, "doc_id", "lang", COLUMNS, copy, bits).collect()
    return sorted(
        ((r.doc_id, r.leaf, r.subroot, r.root, sha(r.siblings), r.folded_root, r.verified) for r in found), key=str
    )


@pytest.mark.parametrize("bits", [1, 2, 12])
def test_manifest_of_odd_rows(spark, bits):
    rows = [(i, "web" if i % 3 else None, "en", 7 * i, f"text {i}") for i in range(37)]
    rows += [(i, "é中", "de", None, "") for i in range(8)] + [(3, "web", "de", 2, None)] * 5 + [(1, None, None, None, None)]
    rows += [(None, "a", "fr", 1, "x" * 100_000), (None, "b", "fr", 1, "y"), (99, "", "", 0, " "), (5, "s", "ß", 3, "z")]
    df = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint, text string")
    df = df.repartition(5).selectExpr("*", "1 AS pos", "'t' AS tree", "2 AS total", "'n' AS node", "'b' AS block", "3 AS id")
    assert manifest_rows(df, bits) == plain_manifest(rows)


def test_manifest_of_one_leaf_and_of_none(spark):
    df = spark.createDataFrame([(4, "s", "en", 1, "t")], "doc_id bigint, source string, lang string, n_chars bigint, text string")
    row = merkle_manifest.manifest(df, "doc_id", "lang", COLUMNS).first()
    assert row.leaf == row.subroot == row.root == row.folded_root and row.siblings == row.sides == "" and row.verified
    assert merkle_manifest.manifest(df.limit(0), "doc_id", "lang", COLUMNS).collect() == []
    with pytest.raises(ValueError, match="pos"):
        merkle_manifest.manifest(df.withColumnRenamed("doc_id", "pos"), "pos", "lang", ["pos"])


def test_manifest_query_by_definition(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select(*COLUMNS).collect()
    found = sorted(map(tuple, queries.op13_merkle_manifest(spark, SF).collect()), key=str)
    assert found == plain_manifest(list(map(tuple, docs)))
    assert math.isclose(sum(r[-1] for r in found) / len(found), 6 / 7, abs_tol=0.05)
