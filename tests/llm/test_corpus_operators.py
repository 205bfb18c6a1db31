"""SimHash, mixing, URL templates, training order and the pipeline against brute force."""

import hashlib
import math
import re
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from lamina.llm import byte_bpe, fair_mix, queries, simhash_tiles, training_order, url_templates
from lamina.llm.common import smallest_reached
from lamina.session import scratch

ODD = [
    (1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "a b c d"), (5, "a b c d"), (None, "the the the"), (None, None),
    (6, "word " * 40_000), (7, "Naïve ΣΊΓΜΑ"), (8, "naïve ΣΊΓΜΑ"), (9, "x\x1cy z"),
]


def simhash(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(bytes(
        b + 32 if 65 <= b <= 90 else b for b in range(256))))
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(rows):
    prints = [simhash(t) for _, t in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(len(rows)) if (prints[i] ^ prints[j]).bit_count() <= 3]
    _, root = smallest_reached(*np.array(pairs).T)
    low = {g: min((rows[i][0] for i in range(len(rows)) if root[i] == g and rows[i][0] is not None), default=None) for g in set(root)}
    return sorted(((k, f"{p:016x}", low[g]) for (k, _), p, g in zip(rows, prints, root)), key=str)


def near_copies(seed, n):
    rng = np.random.default_rng(seed)
    base = [f"w{x}" for x in rng.integers(0, 5000, 300)]
    rows = []
    for i in range(n):
        words = list(base) if i % 3 else [f"v{x}" for x in rng.integers(0, 5000, 200)]
        for at in rng.integers(0, len(words), i % 4):
            words[at] = f"z{i}"
        rows.append((i, " ".join(words)))
    return rows


@pytest.mark.parametrize("rows", [ODD, near_copies(1, 90)])
def test_simhash_groups(documents, rows):
    found = simhash_tiles.near_duplicates(documents(rows)).select(
        "id", simhash_tiles.hex_fingerprint("fp"), "component_id"
    )
    assert sorted(map(tuple, found.collect()), key=str) == brute_groups(rows)


def test_simhash_tiles_of_a_crowded_cell(spark, monkeypatch):
    monkeypatch.setattr(simhash_tiles, "TILE", 8)
    rng = np.random.default_rng(3)
    prints = {int(rng.integers(0, 1 << 62))}
    while len(prints) < 400:
        prints.add(list(prints)[int(rng.integers(0, len(prints)))] ^ (1 << int(rng.integers(0, 63))))
    values = np.array(sorted(prints), dtype=np.uint64).view(np.int64)
    fps = spark.createDataFrame([(int(v),) for v in values], "fp long")
    links = {tuple(r) for r in simhash_tiles.links(fps).collect()}
    close = np.bitwise_count(values.view(np.uint64)[:, None] ^ values.view(np.uint64)[None, :]) <= 3
    i, j = np.nonzero(close)
    nodes, root = smallest_reached(values[i], values[j])
    left, right = np.array(sorted(links)).T
    have = dict(zip(*[x.tolist() for x in smallest_reached(left, right)]))
    assert all(have.get(a, a) == b for a, b in zip(nodes.tolist(), root.tolist()))


def test_one_document_of_each_group_stays(documents):
    rows = near_copies(2, 60) + [(500, "same words here now"), (500, "same words here now"), (None, "lonely null id here")]
    docs = documents(rows)
    kept = simhash_tiles.deduplicate(docs)
    assert kept.columns == docs.columns
    want = {(k if k is not None else None) for _, _, k in brute_groups(rows)}
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted(want, key=str)
    assert simhash_tiles.deduplicate(docs.limit(0)).count() == 0
    assert simhash_tiles.near_duplicates(docs.limit(0)).count() == 0


def mixed(docs):
    return sorted(map(tuple, fair_mix.mix(docs).select("id", "size", "source_size", "target", "taken").collect()), key=str)


def by_sql(rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", [list((r + (None,) * 3)[:3]) for r in rows])
    found = con.execute(queries.suite.oracles["op9_fair_mix"])
    names = [d[0] for d in found.description]
    at = [names.index(c) for c in ("doc_id", "size", "source_size", "target", "taken")]
    return sorted((tuple(r[i] for i in at) for r in found.fetchall()), key=str)


def sources(seed, n):
    rng = np.random.default_rng(seed)
    names = ["a", "b", "é", "z", None, ""]
    return [(i, "w " * int(rng.geometric(0.05)), names[int(x)]) for i, x in enumerate(rng.choice(6, n, p=[.5, .2, .1, .1, .05, .05]))]


@pytest.mark.parametrize("rows", [sources(1, 500), sources(2, 40), [(1, "x y", "a")], [(1, None, "a"), (2, "", "b")]])
def test_mix_agrees_with_sql(documents, rows):
    assert mixed(documents(rows)) == by_sql(rows)


def test_mix_on_odd_rows(documents):
    docs = documents([(*r, "s" if i % 2 else None) for i, r in enumerate(ODD)])
    first = mixed(docs)
    assert first == mixed(docs.repartition(5))
    assert all(0 <= r[4] <= 2 * r[1] for r in first) and len(first) == len(ODD)
    assert mixed(docs.limit(0)) == []


def test_mix_reaches_its_targets(documents):
    docs = documents(sources(5, 3000))
    found = fair_mix.mix(docs).groupBy("source", "target", "source_size").agg(F.sum("taken").alias("taken"), F.max("size").alias("top"))
    rows = found.collect()
    assert sum(r["target"] for r in rows) == pytest.approx(1.5 * sum(r["source_size"] for r in rows))
    for r in rows:
        assert abs(r["taken"] - r["target"]) <= 2 * r["top"]


def test_the_mix_itself_repeats_documents(documents):
    rows = sources(6, 200) + [(900, "p q", "a"), (900, "p q", "a"), (900, "r s", "a")]
    docs = documents(rows)
    plan = fair_mix.mix(docs).groupBy("id").agg(F.sum("copies").alias("n")).where("n > 0")
    made = fair_mix.materialise(docs)
    assert made.columns == docs.columns
    assert {tuple(r) for r in made.groupBy("doc_id").count().collect()} == {tuple(r) for r in plan.collect()}


def rule_by_hand(host, path):
    fits = [
        (len(rule), rule, verdict) for verdict, rule in queries.URL_RULES
        for name, _, rest in [rule.partition("/")]
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest)
    ]
    return max(fits)[1:] if fits else (None, None)


URLS = [
    "http://A.Example.ORG/es/1?x", "https://example.org/en/12#f", "example.org/en/1", None, "", "ftp://org", "http://org/",
    "http://x.com/fr/a", "http://x.com/de/a/b/c/d/e/f/g/h/i", "http://xcom/de/", "http://com/fr?/", "http://a://b/c",
    "http://É.com/de/é", "http://h.net/" + "s/" * 3000, "http://example.org/es/?", "https://h.net/2024-01-02/abc",
]


def pages(spark, urls):
    return spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)], "page_id long, url string, host string, rule string")


def test_rules_hosts_and_paths(spark):
    for r in url_templates.judge(pages(spark, URLS + URLS), queries.URL_RULES).collect():
        url = (URLS + URLS)[r["id"]] or ""
        rest = url.partition("://")[2] if "://" in url else ""
        host, path = re.fullmatch(r"([^/?#]*)([^?#]*).*", rest, re.S).groups()
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
        rule, verdict = rule_by_hand(host, path)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] in ("allow", "block") and verdict in (None, r["verdict"])
    assert url_templates.judge(pages(spark, URLS).limit(0), queries.URL_RULES).count() == 0


def test_templates_learn_from_labels(spark):
    # one branch is spam throughout, one clean; slugs and numbers vary; unlabelled URLs follow
    rows = [(i, f"http://s.net/casino/{i}/win-{(i + 1) * 7919}", 1 if i % 2 else None) for i in range(200)]
    rows += [(1000 + i, f"http://s.net/news/{i}/story-{(i + 1) * 104729}", 0 if i % 2 else None) for i in range(200)]
    rows += [(2000 + i, f"http://t.net/{w}/{i}", None) for i in range(50) for w in ("p", "q")]
    rows += [(3000 + i, f"http://u.net/{'abcdefghij'[i % 10] * (3 + i // 10)}x{'klmn'[i % 4]}/end", None) for i in range(100)]
    df = spark.createDataFrame(rows, "page_id long, url string, spam int")
    found = {r["id"]: r for r in url_templates.judge(df, [], label_column="spam").collect()}
    assert all((found[k]["verdict"] == "block") == (k < 1000) for k in found)
    assert found[0]["template"] == "/casino/{n}/win-{n}"
    assert found[2000]["template"] == found[2049]["template"]  # p and q go on alike
    assert found[3000]["template"] == found[3050]["template"] == "/{*}/end"


def test_purity_by_hand(spark):
    rows = [(i, f"http://a.net/x/{i}", i % 4 != 0) for i in range(8)] + [(100 + i, f"http://b.net/y{chr(97 + i)}", False) for i in range(8)]
    df = spark.createDataFrame([(k, u, int(b)) for k, u, b in rows], "page_id long, url string, spam int")
    found = {r["id"]: r["purity"] for r in url_templates.judge(df, [], label_column="spam").collect()}
    overall = 6 / 16
    assert found[0] == pytest.approx((6 + 4 * overall) / (8 + 4))
    assert found[100] == pytest.approx((0 + 4 * overall) / (8 + 4))  # the eight leaves are merged


def brute_templates(rows):
    """Template, purity and evidence of each path by one host's tree of nodes, for (parts, blocked, labelled) rows."""
    paths = {}
    for parts, blocked, labelled in rows:
        old = paths.get(parts, (0, 0, 0))
        paths[parts] = (old[0] + 1, old[1] + blocked, old[2] + labelled)
    template = {p: () for p in paths}
    open_paths, level = set(paths), 0
    while open_paths:
        nodes = {}
        for p in open_paths:
            nodes.setdefault(template[p], set()).add(p)
        following = set()
        for node, held in nodes.items():
            here = {p for p in held if len(p) > level and len(held) > 1}
            for p in held - here:
                template[p] = node + p[level:]
            branches = {}
            for p in here:
                b = branches.setdefault(p[level], {"sums": [0, 0, 0], "forms": Counter()})
                b["sums"] = [x + y for x, y in zip(b["sums"], paths[p])]
                b["forms"][p[level + 1] if len(p) > level + 1 else ""] += paths[p][0]
            for b in branches.values():
                _, blocked, labelled = b["sums"]
                b["form"] = max(b["forms"], key=lambda f: (b["forms"][f], f))
                b["kind"] = "none" if not labelled else "allowed" if not blocked else "blocked" if blocked == labelled else "mixed"
            kinds = {b["kind"] for b in branches.values()} - {"none"}
            singles = sum(b["sums"][0] == 1 for b in branches.values())
            below = sum(b["sums"][0] for b in branches.values())
            variable = len(branches) > 1 and singles > 0.5 * below and len(kinds) <= 1 and "mixed" not in kinds
            for name, b in branches.items():
                kin = [c for c in branches.values() if (c["form"], c["kind"]) == (b["form"], b["kind"])]
                pooled = [sum(c["sums"][n] for c in kin) for n in (1, 2)]
                agrees = b["kind"] != "mixed" or (len(kin) > 1 and url_templates.chance(*b["sums"][1:], *pooled) >= 0.05)
                b["name"] = name
                if variable and not name.startswith("{"):
                    b["name"] = "{*}"
                elif not name.startswith("{") and len(kin) > 1 and agrees:
                    b["name"] = "{~" + b["form"] + ("" if b["kind"] == "none" else ":" + b["kind"]) + "}"
            for p in here:
                template[p] = node + (branches[p[level]]["name"],)
            following |= here
        open_paths, level = following, level + 1
    return {p: "/" + "/".join(t) for p, t in template.items()}


def test_templates_are_those_of_a_plain_tree_at_every_depth(spark):
    rng = np.random.default_rng(8)
    rows = []
    for i in range(700):
        parts = [str(rng.choice(list("abcde"))) for _ in range(rng.integers(1, 10))]
        if rng.random() < 0.3:
            parts[-1] = f"only{'xyz'[i % 3]}-{chr(97 + i % 26)}{chr(97 + i // 26)}"
        label = None if rng.random() < 0.6 else int((parts[0] in "ab") ^ (rng.random() < 0.1 * (parts[0] in "bc")))
        rows.append((i, parts, label))
    rows += [(800, list("ab") + ["q"] * 9, 1), (801, list("ab") + ["q"] * 9 + ["r"], None)]
    df = spark.createDataFrame([(i, "http://h.net/" + "/".join(p), k) for i, p, k in rows], "page_id long, url string, spam int")
    want = brute_templates([(tuple(p), k or 0, int(k is not None)) for _, p, k in rows])
    found = url_templates.judge(df, [], label_column="spam").collect()
    assert {r["id"]: r["template"] for r in found} == {i: want[tuple(p)] for i, p, _ in rows}
    groups = {}
    for i, p, k in rows:
        groups.setdefault(want[tuple(p)], []).append(k)
    overall = sum(k or 0 for _, _, k in rows) / sum(k is not None for _, _, k in rows)
    for r in found:
        labels = [k for k in groups[r["template"]] if k is not None]
        if labels:
            assert r["purity"] == pytest.approx((sum(labels) + 4 * overall) / (len(labels) + 4))
        assert r["verdict"] == ("block" if labels and r["purity"] >= 0.5 else "allow")


def test_few_labels_of_siblings_block_nothing(spark):
    rows = [(i, f"http://a.net/de/{i}", 1) for i in range(3)] + [(10, "http://a.net/fr/1", 0)]
    rows += [(100 + i, f"http://a.net/en/{i}", None) for i in range(40)]
    df = spark.createDataFrame(rows, "page_id long, url string, spam int")
    found = {r["id"]: r for r in url_templates.judge(df, [], label_column="spam").collect()}
    # the one label of its sibling does not outweigh the share of all labels, which is 3 in 4
    assert {r["verdict"] for k, r in found.items() if k < 100} == {"block"}
    assert {r["verdict"] for k, r in found.items() if k >= 100} == {"allow"}
    assert len({found[k]["template"] for k in (0, 10, 100)}) == 3
    # an unlabelled branch shows the purity of the node above it
    assert found[100]["purity"] == pytest.approx((3 + 4 * 0.75) / (4 + 4))


def test_chance_is_exact():
    for blocked, labelled, all_blocked, all_labelled in [(3, 3, 3, 4), (1, 5, 9, 20), (0, 4, 10, 14), (7, 10, 8, 30)]:
        ways = {k: math.comb(all_blocked, k) * math.comb(all_labelled - all_blocked, labelled - k) for k in range(labelled + 1)}
        want = sum(w for w in ways.values() if w <= ways[blocked]) / math.comb(all_labelled, labelled)
        assert url_templates.chance(blocked, labelled, all_blocked, all_labelled) == pytest.approx(want)
    assert url_templates.chance(50, 1_000, 1_500, 30_000) == pytest.approx(1.0)
    assert url_templates.chance(500, 1_000, 1_500, 30_000) < 1e-9 and url_templates.chance(2, 2, 2, 2) == 1.0


def test_no_labels_allow_everything(spark):
    found = url_templates.judge(pages(spark, URLS), [])
    assert {r["verdict"] for r in found.collect()} == {"allow"}


@pytest.mark.parametrize("size", [1, 2, 3, 5, 64, 1000, 4097])
def test_slots_are_a_permutation(size):
    slots = training_order.permute(np.arange(size), size, 7)
    assert sorted(slots.tolist()) == list(range(size))
    if size > 100:
        other = training_order.permute(np.arange(size), size, 8)
        assert (slots != other).mean() > 0.9 and abs(np.corrcoef(np.arange(size), slots)[0, 1]) < 0.2


def token_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.integers(0, 65536, int(n)).tolist()) for i, n in enumerate(rng.integers(0, 40, 50))]
    rows += [(None, [10, 10, 10]), (7, None), (8, []), (9, [10] * 1000), (9, [10] * 1000)]
    return rows, spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, ids array<int>, slot int, shard string")


def rebuilt(found, held):
    """Documents' ids in the order of their sequences, from tokens and segments."""
    parts = {}
    for slot, segments in held.items():
        tokens = found[slot]
        for s, after in zip(segments, [*segments[1:], None]):
            piece = tokens[s["start"] : after["start"] if after else len(tokens)]
            parts.setdefault(s["id"], []).append((s["offset"], piece))
    return {k: sorted(v) for k, v in parts.items()}


def test_shards_read_back_whole_and_in_part(spark):
    rows, tokens = token_rows(spark)
    path = scratch(spark, "shards")
    size = training_order.write(training_order.pack(tokens.repartition(3), "doc_id", "ids", 16, 1, 0), path, 10, 99)
    found = training_order.read(spark, path, 16, 10).collect()
    assert sorted(r["slot"] for r in found) == list(range(size)) and all(r["shard"] == r["slot"] // 10 for r in found)
    held = {r["slot"]: r["segments"] for r in training_order.segments(spark, path).collect()}
    whole = rebuilt({r["slot"]: r["tokens"] for r in found}, held)
    for key in {k for k, _ in rows}:
        mine = [v or [] for k, v in rows if k == key]
        # the pieces of one document follow each other; repeated rows give repeated pieces
        assert sorted(x for _, p in whole[key] for x in p) == sorted(x for v in mine for x in [*v, 1])
        if len(mine) == 1:
            assert [x for _, p in whole[key] for x in p] == [*mine[0], 1]
    assert sum(len(r["tokens"]) < 16 for r in found) <= 3  # the last of each task
    tokens_of = {r["slot"]: r["tokens"] for r in found}
    resumed = training_order.read(spark, path, 16, 10, start=13, stop=34).collect()
    assert {r["slot"]: r["tokens"] for r in resumed} == {s: tokens_of[s] for s in range(13, 34)}
    shards = spark.read.format("binaryFile").load(f"{path}/shards").select("shard", "length").collect()
    assert sorted(r["shard"] for r in shards) == list(range(-(-size // 10)))
    assert all(r["length"] == training_order.stride(16) * min(10, size - 10 * r["shard"]) for r in shards)


def test_texts_are_packed_as_their_tokens_are(spark, documents):
    ranks, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    docs = documents(ODD).coalesce(1)
    tokens = byte_bpe.encode(docs, "text", ranks, pattern, ["doc_id"])
    one = training_order.pack(tokens, "doc_id", "ids", 8, 50256, 50256).collect()
    other = training_order.pack_texts(docs, "doc_id", "text", ranks, pattern, 8, 50256, 50256).collect()
    assert one == other


def test_training_order_refuses_what_does_not_fit(spark):
    wide = spark.createDataFrame([(1, [70_000])], "doc_id long, ids array<int>")
    with pytest.raises(Exception, match="16 bits"):
        training_order.pack(wide, "doc_id", "ids", 4, 1, 0).collect()
    empty = training_order.pack(wide.limit(0), "doc_id", "ids", 4, 1, 0)
    path = scratch(spark, "none")
    assert training_order.write(empty, path, 4, 1) == 0
    assert training_order.read(spark, path, 4, 4).count() == training_order.segments(spark, path).count() == 0


def test_pipeline_stages(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash_near_dedup", "source_mix", "byte_bpe"]
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, sf_dir)
        after = spark.createDataFrame(after.collect(), docs.schema)
        assert after.columns == docs.columns
        rows = [(r["doc_id"], r["text"]) for r in before.collect()]
        kept = [r["doc_id"] for r in after.collect()]
        if name == "toxicity":
            toxic = {r["doc_id"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").where("toxic = 1").collect()}
            clean = {r["doc_id"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").where("toxic = 0").collect()}
            assert not clean - set(kept) and len(set(kept) & toxic) <= 0.2 * len(toxic)
        elif name == "simhash_near_dedup":
            assert sorted(kept) == sorted({g for _, _, g in brute_groups(rows)})
        else:
            plan = {r["id"]: r["copies"] for r in fair_mix.mix(before).collect()}
            assert sorted(kept) == sorted(k for k, n in plan.items() for _ in range(n))
        before = after
    last = {r["doc_id"]: r for r in corpus_pipeline.to_tokens(spark, before, sf_dir).collect()}
    for row in before.collect():
        assert last[row["doc_id"]]["decoded_sha256"] == hashlib.sha256(row["text"].encode()).hexdigest()
    assert corpus_pipeline.run(spark, sf_dir).count() == before.count()


def test_pipeline_stages_on_odd_rows_and_nothing(spark, documents):
    sf_dir = "/root/testdata/sf0.001"
    docs = documents([(*r, "s" if i % 2 else None) for i, r in enumerate(ODD)])
    for docs in (docs, docs.limit(0)):
        n = docs.count()
        for name, stage in corpus_pipeline.STAGES:
            found = stage(spark, docs, sf_dir)
            if name != "byte_bpe":
                assert found.columns == docs.columns
            kept = found.count()
            assert kept <= (2 * n if name == "source_mix" else n)
            if name == "simhash_near_dedup":
                assert kept == len({simhash(r["text"]) for r in docs.select("text").collect()}) or kept < n or not n


def test_finished_templates_are_one_table(spark):
    rows = [("h", ["a", "b", "c", str(n)], 1, n % 2, 1) for n in range(8)] + [("h", ["a", "x"], 1, 0, 1), ("h", ["z"], 1, 0, 1)]
    paths = spark.createDataFrame(rows, "host string, parts array<string>, urls bigint, blocked bigint, labelled bigint")
    found = url_templates.grow(paths)
    assert "Union" not in found._jdf.queryExecution().executedPlan().toString()
    assert sorted(tuple(r.parts) for r in found.collect()) == sorted(tuple(r[1]) for r in rows)
