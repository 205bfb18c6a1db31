"""Toxicity, byte-level BPE, language model and license scan against brute force."""

import hashlib
import math
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lamina.llm import byte_bpe, elias_fano, license_scan, ngram_lm, queries, toxicity

SF = "/root/testdata/sf0.01"
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
ODD = [
    (1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "a b c d"), (5, "a b c d"), (None, "the the the"),
    (6, "word " * 40_000), (7, "x" * 200_000), (8, "naïve ΣΊΓΜΑ 中文 \U0001f600 \x1c\x85"), (9, "İstanbul ǅ"),
]


def remainder(key, n):
    return zlib.crc32(b"" if key is None else str(key).encode()) % n


@pytest.fixture(scope="module")
def reference():
    ranks = byte_bpe.load_ranks(RANKS)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60) | st.text(alphabet="ab ", max_size=60) | st.text(alphabet="thertion' 0.\n", max_size=80))
def test_pieces_encode_as_the_reference_does(reference, text):
    text = text.encode("utf-8", "replace").decode()
    found = byte_bpe.encoder(RANKS, public_tokenizers.PATTERN).encode(text)
    assert found.tolist() == reference.encode_ordinary(text)
    raw, sizes = byte_bpe.decoder(RANKS).decode(found)
    assert raw.tobytes() == text.encode() and sizes.sum() == len(raw)


def test_small_vocabulary_with_unreachable_entries():
    # "abc" is never made by merges (its parts meet too late), but is right for a whole piece
    ranks = {bytes([b]): i for i, b in enumerate(b"abcd")} | {b"bc": 4, b"ab": 5, b"cd": 6, b"abc": 7}
    model = byte_bpe.Encoder(ranks, r"\S+")
    table = tiktoken.Encoding("t", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})
    for n in range(1, 9):
        for k in range(4**min(n, 5)):
            text = "".join("abcd"[k >> (2 * i) & 3] for i in range(n))
            assert model.encode(text).tolist() == table.encode_ordinary(text), text


def test_bpe_query_on_odd_rows(spark, documents, reference):
    found = byte_bpe.digests(documents(ODD), "doc_id", "text", RANKS, public_tokenizers.PATTERN).collect()
    want = []
    for key, text in ODD:
        ids = reference.encode_ordinary(text or "")
        joined = " ".join(map(str, ids)).encode()
        want.append((key, len(ids), hashlib.sha256(joined).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(tuple, found), key=str) == sorted(want, key=str)
    assert byte_bpe.digests(documents(ODD).limit(0), "doc_id", "text", RANKS, public_tokenizers.PATTERN).count() == 0


def test_unknown_ids_are_an_error():
    with pytest.raises(ValueError):
        byte_bpe.decoder(RANKS).decode(np.array([50256]))
    assert byte_bpe.decoder(RANKS).decode(np.array([], dtype=np.int64))[0].tobytes() == b""


def test_bpe_query_on_a_whole_table(spark, reference):
    found = {r["doc_id"]: r for r in queries.suite.queries["op3_byte_bpe"](spark, "/root/testdata/sf0.001").collect()}
    for row in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect():
        ids = reference.encode_ordinary(row["text"])
        assert found[row["doc_id"]]["n_tokens"] == len(ids)
        assert found[row["doc_id"]]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()


@pytest.mark.parametrize("n, universe", [(0, 5), (1, 1), (7, 7), (300, 300), (300, 10**12), (5000, 40)])
def test_elias_fano_get_and_successor(n, universe):
    rng = np.random.default_rng(n)
    values = np.sort(rng.integers(0, universe, n))
    packed = elias_fano.EliasFano(*elias_fano.EliasFano.pack(values, universe))
    assert (packed.get(np.arange(n)) == values).all()
    asked = np.concatenate([rng.integers(0, universe, 500), values])
    at, equal = packed.successor(asked)
    assert (at == np.searchsorted(values, asked)).all() and (equal == np.isin(asked, values)).all()


def test_trie_finds_pairs_relative_to_their_context(tmp_path):
    rng = np.random.default_rng(5)
    pairs = np.unique(rng.integers(0, [40, 900], (3000, 2)), axis=0)
    layout = elias_fano.Trie.write(f"{tmp_path}/t", pairs[:, 0], pairs[:, 1], np.arange(len(pairs)) % 65536)
    trie = elias_fano.Trie(f"{tmp_path}/t", layout)
    asked = rng.integers(0, [60, 1200], (4000, 2))
    known = {tuple(p): i for i, p in enumerate(pairs.tolist())}
    assert trie.find(asked[:, 0], asked[:, 1]).tolist() == [known.get(tuple(a), -1) for a in asked.tolist()]
    assert trie.codes[: len(pairs)].tolist() == [i % 65536 for i in range(len(pairs))]


def brute_scores(rows):
    tokens = [((t or "").encode().lower().split() + [ngram_lm.END], remainder(k, 10) == 0, k) for k, t in rows]
    unigrams, bigrams = Counter(), Counter()
    for words, held, _ in tokens:
        if not held:
            unigrams.update(words)
            bigrams.update(zip([ngram_lm.END, *words], words))
    total, kinds, mu = sum(unigrams.values()), len(unigrams), ngram_lm.MU

    def p(word):
        return (unigrams[word] + 0.1) / (total + 0.1 * (kinds + 1))

    for words, held, key in tokens:
        pairs = list(zip([ngram_lm.END, *words], words))
        yield (
            key, held, len(words), sum(unigrams[w] > 0 for w in words), total, sum(math.log10(p(w)) for w in words),
            sum(math.log10((bigrams[v, w] + mu * p(w)) / (unigrams[v] + mu)) for v, w in pairs),
        )


@pytest.mark.parametrize("rows", [ODD, [(0, None)], [(k, f"a b {k % 3} c") for k in range(60)]])
def test_language_model_scores(documents, rows):
    found = sorted(map(tuple, ngram_lm.score(documents(rows)).collect()), key=str)
    want = sorted(brute_scores(rows), key=str)
    assert len(found) == len(want)
    for have, expected in zip(found, want):
        assert have[:5] == expected[:5]
        assert have[5] == pytest.approx(expected[5], rel=1e-9)
        # two coded factors of a token's probability are off by half a step at most
        assert abs(have[6] - expected[6]) <= expected[2] * ngram_lm.STEP * 1.01


def test_language_model_sends_a_pair_once_per_block(documents, monkeypatch):
    sent, scored = [], ngram_lm._scored
    monkeypatch.setattr(ngram_lm, "_scored", lambda df: sent.append(df) or scored(df))
    rows = [(k, "a b " * 500 + f"c{k % 3}") for k in range(40)]
    found = ngram_lm.score(documents(rows).repartition(4)).collect()
    for have, expected in zip(sorted(map(tuple, found)), sorted(brute_scores(rows))):
        assert have[:5] == expected[:5] and abs(have[6] - expected[6]) <= expected[2] * ngram_lm.STEP * 1.01
    lists = [ngram_lm._array(r[0], "<i8") for r in sent[0].where("v is not null").select("v").collect()]
    # end a, a b, b a, b c0, b c1, b c2, c0 end, c1 end, c2 end
    assert sum(map(len, lists)) <= 4 * 9


def test_language_model_of_an_empty_table(documents):
    assert ngram_lm.score(documents(ODD).limit(0)).count() == 0


def test_language_model_beats_its_base_on_held_out_texts(spark):
    found = queries.suite.queries["op4_ngram_lm"](spark, SF).where("held_out")
    assert found.agg(F.sum(F.col("score") - F.col("base_score"))).first()[0] > 0


def labelled(spark, documents, texts):
    docs = documents([(i, t) for i, (t, _) in enumerate(texts)])
    return docs, spark.createDataFrame([(i, k) for i, (_, k) in enumerate(texts)], "doc_id long, toxic int")


def test_swapped_terms_score_alike(spark, documents):
    # toxic lines mention one group, clean ones another: a plain classifier learns the group
    texts = [(f"you muslim fool number{i} go", 1) for i in range(80)] + [(f"a christian friend number{i}", 0) for i in range(80)]
    docs, labels = labelled(spark, documents, texts)
    gap = {}
    for penalty in (0.0, 10.0):
        model = toxicity.fit(docs, labels, penalty=penalty)
        gap[penalty] = abs(model.score("a muslim neighbour") - model.score("a christian neighbour"))
        assert model.score("you fool") > 0.5 > model.score("a friend")
    assert gap[10.0] < 0.05 < gap[0.0]


def test_toxicity_of_odd_rows(spark, documents):
    docs, labels = labelled(spark, documents, [("nice day", 0), ("vile scum", 1)] * 20)
    labels = labels.unionByName(spark.createDataFrame([(None, 1), (3, None), (99, 1)], labels.schema))
    model = toxicity.fit(docs, labels)
    scored = toxicity.score(documents(ODD), model, output="p").collect()
    assert len(scored) == len(ODD) and all(0 <= r["p"] <= 1 for r in scored)
    assert len({r["p"] for r in scored if not (r["text"] or "").strip()}) == 1
    with pytest.raises(ValueError):
        toxicity.score(documents(ODD), model, output="score")
    assert toxicity.score(documents(ODD).limit(0), model, output="p").count() == 0


@pytest.mark.parametrize("kinds", [(), (0,), (1,)])
def test_toxicity_without_both_labels(spark, documents, kinds):
    docs, labels = labelled(spark, documents, [(f"text {i}", k) for i in range(30) for k in kinds])
    model = toxicity.fit(docs, labels)
    assert not model.weights and (model.score("any") > 0.5) == (kinds == (1,))


def test_toxicity_learns_from_its_folds_only(spark):
    found = queries.suite.queries["op1_toxicity"](spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    both = found.join(labels, "doc_id").toPandas()
    assert (both.held_out == [remainder(k, 5) == 0 for k in both.doc_id]).all()
    held = both[both.held_out]
    assert (held.predicted == held.toxic).mean() > 0.9
    assert ((held.score >= 0.5).astype(int) == held.predicted).all()
    flipped = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, 1 - F.col("toxic"))
                                .otherwise(F.col("toxic")))
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert toxicity.fit(docs, labels) == toxicity.fit(docs, flipped)


MIT = license_scan.TEMPLATES["MIT-text"]


def scanned(documents, rows):
    found = license_scan.summary(license_scan.scan(documents(rows))).collect()
    return {r["id"]: tuple(r)[1:] for r in found}


def test_licenses_are_found_with_their_spans(documents):
    words = MIT.split()
    edited = " ".join([*words[:20], "really", *words[20:50], *words[52:]])
    text = "Before. " + MIT + " After."
    rows = [
        (1, text), (2, "x " * 3000 + edited + " y" * 3000), (3, " ".join(words[:40])),
        (4, "The MIT License was released in the 1980s"), (5, "Released under the MIT License.\nLicensed under CC BY-NC 4.0."),
        (6, MIT.upper().replace(" ", "\n")),
    ]
    found = scanned(documents, rows)
    assert found[1] == (1, "MIT-text", 1.0, 8, 8 + len(MIT) - 1)
    assert found[2][:2] == (1, "MIT-text") and 0.95 < found[2][2] < 1 and found[2][3] == 6000
    assert found[3][0] == found[4][0] == 0
    assert found[5][0] == 2 and found[6][:3] == (1, "MIT-text", 1.0)


@pytest.mark.parametrize("copies", [2, 4, 9])
def test_consecutive_copies_of_a_notice_count_each(copies):
    index = license_scan.Index(license_scan.TEMPLATES)
    for name, notice in license_scan.TEMPLATES.items():
        found = index.matches("\n".join([notice] * copies), 0.8)
        assert [m["license"] for m in found] == [name] * copies
        assert [m["coverage"] for m in found] == [1.0] * copies
        assert [m["start"] for m in found] == [i * (len(notice) + 1) for i in range(copies)]


def test_license_scan_of_odd_rows(documents):
    found = scanned(documents, ODD)
    assert all(v == (0, None, None, None, None) for v in found.values())
    assert license_scan.scan(documents(ODD).limit(0)).count() == 0
    with pytest.raises(ValueError):
        license_scan.Index({"short": "too short a text"})


def test_license_lines_of_the_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").toPandas().set_index("doc_id")
    found = queries.suite.queries["op6_license_scan"](spark, SF).toPandas().set_index("doc_id")
    notices = [license_scan.TEMPLATES[k] for k in ("Apache-2.0", "CC-BY-NC-4.0", "MIT", "GPL-3.0")]
    planted = docs.text.map(lambda t: any(n in t for n in notices))
    assert ((found.n_matches > 0) == planted).all() and planted.any()
    for key, row in found[found.n_matches > 0].iterrows():
        span = docs.text[key][int(row.span_start) : int(row.span_end)]
        assert license_scan.split(span) == license_scan.split(license_scan.TEMPLATES[row.license])


def test_a_text_of_license_lines_takes_linear_time():
    index = license_scan.Index(license_scan.TEMPLATES)
    line = license_scan.TEMPLATES["MIT"]
    took = {}
    for copies in (1_000, 8_000):
        started = time.process_time()
        found = index.matches("\n".join([line] * copies), 0.8)
        took[copies] = time.process_time() - started
        assert len(found) == copies and all(m["license"] == "MIT" and m["coverage"] == 1.0 for m in found)
        assert all(a["end"] <= b["start"] for a, b in zip(found, found[1:]))
    assert took[8_000] < 24 * took[1_000] + 0.5
    print(took)
