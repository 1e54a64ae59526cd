"""Quality rules, URL verdicts, benchmark passages, shards and toxicity against plain versions."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from forecourt.llm import decontaminate, quality, queries, sharding, toxicity, url_filter
from tests.llm.conftest import rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_statistics(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
    often = Counter(windows)
    covered = {k + j for k, w in enumerate(windows) if often[w] > 1 for j in range(5)}
    dup = sum(x in lines[:k] for k, x in enumerate(lines))
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


def plain_quality(pairs):
    out = []
    for i, t in pairs:
        stats = plain_statistics(t)
        out.append((i, *stats, stats[0] < 10 or 100 * stats[4] > 20 * stats[0]))
    return sorted(out, key=repr)


BASE = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_quality_statistics(spark, folder, texts):
    found = queries.quality_rules(spark, folder)
    assert rows(found.select(*BASE)) == plain_quality(texts.items())
    assert found.where("base_failed AND kept").count() == 0
    assert [t for c, t in found.dtypes if c in ("base_failed", "kept")] == ["boolean", "boolean"]


def test_quality_of_edge_rows(edge, nothing, labels):
    found = quality.judge(edge, labels.where(F.lit(False)))
    few = edge.where("doc_id is null or doc_id != 4")
    assert rows(quality.judge(few, labels).select(*BASE)) == plain_quality([(r["doc_id"], r["text"]) for r in few.collect()])
    assert found.where("kept = base_failed").count() == 0  # nothing learned: the base rules decide
    assert quality.keep_documents(edge, labels).columns == edge.columns
    assert quality.judge(nothing, labels).collect() == []


def test_learned_rules_reject_bad_and_keep_good(spark):
    folder = "/root/testdata/sf0.1"
    judged = queries.quality_rules(spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    passed = judged.where("NOT base_failed")
    count = {(r["quality"], r["kept"]): r["count"] for r in passed.groupBy("quality", "kept").count().collect()}
    assert count.get((1, False), 0) <= 0.002 * count[1, True]
    assert count[0, False] >= 0.9 * (count[0, False] + count.get((0, True), 0))


def test_a_planted_list_is_found():
    rng = np.random.default_rng(4)
    table = pd.DataFrame({"n_words": rng.integers(10, 2000, 4000).astype(float), "symbols_per_word": rng.random(4000)})
    table["bad"] = (table["symbols_per_word"] > 0.8) & (table["n_words"] > 700) | (table["n_words"] <= 100)
    rules = quality.learn(table)
    verdict = np.zeros(len(table), bool)
    for rule in rules:
        verdict |= quality._covered(rule, table)
    assert (verdict == table["bad"]).mean() > 0.98
    assert quality.expression(rules).count("WHEN") == len(rules) >= 2
    assert quality.learn(table.head(0)) == [] and quality.expression([]) == "true"


def plain_host_path(url):
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    host = re.match(r"[^/?#]*", rest)[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), re.match(r"[^?#]*", rest[len(host):])[0]


def plain_rule(host, path):
    fits = []
    for rule in queries.URL_RULES:
        name, _, rest = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest):
            fits.append(rule)
    return max(fits, key=len, default=None)


def test_url_verdicts(spark, folder):
    urls = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    for r in queries.url_verdicts(spark, folder).collect():
        host, path = plain_host_path(urls[r["page_id"]])
        rule = plain_rule(host, path)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == (queries.URL_RULES[rule] if rule else "block" if r["score"] >= 0.5 else "allow")


ODD_URLS = [
    None, "", "no scheme", "http://", "HTTP://WWW.Example.ORG/es/9?x#y", "http://example.org", "http://a.example.org/en/12", "x://org/",
    "http://notexample.org/es/1", "http://b.com/fr/a/b", "http://b.com/de/?q=1", "http://b.com?q=/de/", "a://b://c/d", "http://é.com/fr/x\ny",
]


def test_odd_urls(spark):
    pages = spark.createDataFrame([(k, u, "h", "r") for k, u in enumerate([*ODD_URLS, *ODD_URLS])], "page_id int, url string, host string, rule string")
    for r in url_filter.judge(pages, queries.URL_RULES, None).collect():
        host, path = plain_host_path(ODD_URLS[r["page_id"] % len(ODD_URLS)])
        assert (r["host"], r["path"], r["rule"], r["score"]) == (host, path, plain_rule(host, path), 0.0)
    assert url_filter.judge(pages.where("false"), queries.URL_RULES, None).collect() == []
    assert url_filter.train(pages.withColumn("blocked", F.lit(1))) is None


def test_boosted_trees_on_unseen_urls(spark):
    folder = "/root/testdata/sf0.1"
    urls = sorted(r["url"] for r in spark.read.parquet(f"{folder}/pages.parquet").collect())
    bad = [int(any(s in plain_host_path(u)[0] for s in queries.URL_SEEDS)) for u in urls]
    random.Random(5).shuffle(both := list(zip(urls, bad)))
    cut = len(both) * 2 // 3
    model = url_filter.fit(*map(list, zip(*both[:cut])))
    truth = np.array([b for _, b in both[cut:]])
    assert ((model.probability([u for u, _ in both[cut:]]) >= 0.5) == truth).mean() > 0.99


def edit_distance(a, b):
    """Least edits between ``a`` and any run of ``b``."""
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        before, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(before[j - 1] + (x != y), before[j] + 1, row[-1] + 1))
    return min(row)


def test_exact_edit_distance():
    rnd = random.Random(2)
    for _ in range(300):
        a, b = [[rnd.randrange(4) for _ in range(rnd.randint(1, n))] for n in (12, 20)]
        distance, start, end = decontaminate.best_match(a, b)
        assert distance == edit_distance(a, b) == edit_distance(a, b[start:end])


def test_passages_of_documents(spark, folder, texts):
    items = {r["item_id"]: decontaminate.item_words(r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()}
    want = set()
    for i, t in texts.items():
        words = decontaminate.item_words(t)
        for k, item in items.items():
            if sum(w in set(words) for w in item) >= 0.8 * len(item):
                d = edit_distance(item, words)
                if d <= decontaminate.edits_allowed(len(item), 0.8):
                    want.add((i, k, d))
    got = {(r["doc_id"], r["item_id"], r["distance"]) for r in queries.benchmark_leaks(spark, folder).collect()}
    assert len(want) > 2 and got <= want and len(got) >= 0.99 * len(want)


def test_edited_passages_reach_the_recall(spark):
    rnd = random.Random(8)
    vocabulary = [f"w{k}" for k in range(3000)]
    items = [[rnd.choice(vocabulary) for _ in range(rnd.randint(15, 60))] for _ in range(60)]
    docs = []
    for k in range(600):
        words = list(items[k % 60])
        for _ in range(decontaminate.edits_allowed(len(words), 0.8)):
            at, kind = rnd.randrange(len(words)), rnd.randrange(3)
            words[at : at + (kind != 1)] = [] if kind == 2 else [rnd.choice(vocabulary)]
        before, after = ([rnd.choice(vocabulary) for _ in range(rnd.randint(0, 200))] for _ in range(2))
        docs.append((k, " ".join(before + words + after)))
    docs += [(k, " ".join(rnd.choice(vocabulary) for _ in range(300))) for k in range(600, 900)]
    benchmark = spark.createDataFrame([(k, " ".join(x)) for k, x in enumerate(items)], "item_id int, text string")
    found = decontaminate.find_items(spark.createDataFrame(docs, "doc_id int, text string"), benchmark).collect()
    hits = {(r["doc_id"], r["item_id"]) for r in found}
    assert all(d < 600 and d % 60 == i for d, i in hits)
    assert len(hits) >= 0.97 * 600
    assert all(r["distance"] <= 0.2 * len(items[r["item_id"]]) + 1e-9 for r in found)


def test_long_items_among_short_ones_reach_the_recall():
    rnd = random.Random(3)
    vocabulary = [f"w{k}" for k in range(3000)]
    words_ = lambda n: [rnd.choice(vocabulary) for _ in range(n)]
    items = [words_(n) for n in [18] * 60 + [250] * 4]
    index = decontaminate.build([(k, " ".join(x)) for k, x in enumerate(items)])
    texts, want = [], set()
    for k in [*range(60, 64)] * 25:
        words = list(items[k])
        for _ in range(decontaminate.edits_allowed(250, 0.8)):
            at, kind = rnd.randrange(len(words)), rnd.randrange(3)
            words[at : at + (kind != 1)] = [] if kind == 2 else words_(1)
        want.add((len(texts), k))
        texts.append(" ".join(words_(50) + words + words_(50)))
    found = decontaminate.Finder(index).find(texts)
    assert {(text, item) for text, item, *_ in found} == want
    for text, item, distance, start, end in found[:10]:
        assert distance == edit_distance(items[item], texts[text].split()) == edit_distance(items[item], texts[text].split()[start:end])


def test_passages_of_edge_rows(spark, edge, nothing):
    items = [(1, "this very line is shared by a NUMBER of documents here"), (1, None), (2, ""), (3, "..."), (None, "a row without an id"), (4, "same")]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    found = decontaminate.find_items(edge, benchmark)
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == {*((i, 1) for i in range(8, 14)), (None, None), (14, 4)}
    assert decontaminate.find_items(nothing, benchmark).collect() == []
    assert decontaminate.find_items(edge, benchmark.where("false")).collect() == []
    kept = decontaminate.without_items(edge, benchmark)
    assert kept.columns == edge.columns and kept.count() == edge.count() - 8


def check_shards(found, shards, largest):
    size, slots = Counter(), {}
    for r in found:
        size[r["shard"]] += r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert set(size) <= set(range(shards))
    mean = sum(size.values()) / shards
    assert all(abs(size.get(k, 0) - mean) <= 2 * largest for k in range(shards))


def test_shards_of_documents(spark, folder, texts):
    found = queries.document_shards(spark, folder).collect()
    want = {i: (len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in texts.items()}
    assert {r["doc_id"]: (r["size"], r["text_crc32"]) for r in found} == want and len(found) == len(want)
    check_shards(found, 16, max(s for s, _ in want.values()))
    assert {(r["law"], r["grown_shard"]) for r in found} == {("bytes", None)}


def test_shards_of_a_hot_text(spark):
    rows_ = [(k, "hot text " * 20 if k % 2 else f"text {k} " * (k % 50)) for k in range(6000)]
    placed = sharding.shard_by_bytes(spark.createDataFrame(rows_, "doc_id bigint, text string").repartition(5), 8)
    found = placed.withColumn("size", sharding.record_size()).collect()
    assert len(found) == 6000
    check_shards(found, 8, 600)


def test_shards_of_edge_rows(edge, nothing):
    placed = sharding.shard_by_bytes(edge, 4)
    assert placed.count() == edge.count()
    assert sorted(placed.columns) == sorted([*edge.columns, "slot"])
    found = placed.withColumn("size", sharding.record_size()).collect()
    check_shards(found, 4, max(r["size"] for r in found))
    assert sharding.shard_by_bytes(nothing, 4).collect() == []


def test_splitters_count_keys_below():
    bounds_h, bounds_i = np.array([1, 5, 5, 5, 9]), np.array([0, 2, 4, 6, 0])
    h, i = np.array([0, 1, 1, 5, 5, 5, 5, 9, 10]), np.array([0, 0, 1, 1, 2, 3, 7, 0, 0])
    want = [sum((b, c) < (x, y) for b, c in zip(bounds_h, bounds_i)) for x, y in zip(h, i)]
    assert sharding._range_of(h, i, bounds_h, bounds_i).tolist() == want


def test_toxicity_of_held_out_documents(spark):
    folder = "/root/testdata/sf0.1"
    scored = queries.toxicity_scores(spark, folder)
    held = scored.where("held_out").join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").collect()
    assert len(held) > 300
    assert np.mean([r["predicted"] == r["toxic"] for r in held]) > 0.93
    assert all((r["score"] >= 0.5) == (r["predicted"] == 1) and 0 <= r["score"] <= 1 for r in held)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in scored.limit(500).collect())


def labelled(spark, toxic, ordinary):
    return spark.createDataFrame([(t, 1) for t in toxic] + [(t, 0) for t in ordinary], "text string, toxic int")


@pytest.fixture(scope="module")
def toxic_model(spark):
    toxic = [f"some words x{k} you utter blockhead said n{k * 7} number" for k in range(60)]
    toxic = [t.replace("utter", f"utter{k % 9}").replace("said", f"said{k % 7}") for k, t in enumerate(toxic)]
    ordinary = [f"some words x{k} you utter{k % 9} what a day said{k % 7} n{k * 7} number" for k in range(160)]
    return toxicity.fit(labelled(spark, toxic, ordinary))


def called(model, text):
    gains = toxicity.Distances(model.ordinary, model.toxic).gains(text, model.discount)
    return toxicity.score(gains, model.thresholds)[0] >= 0.5


def test_toxicity_of_edge_rows(spark, edge, nothing, labels, toxic_model):
    found = toxicity.score_documents(edge, toxic_model).collect()
    scored = {(r["doc_id"], r["predicted"]) for r in found}
    assert len(scored) == len({i for i, _ in scored}) and len(found) == edge.count()  # rows of one id that lack the word agree
    assert not any(p for i, p in scored if i in (1, 2, 3, None))
    assert called(toxic_model, "What a BLOCKHEAD!") and not called(toxic_model, "what a day")
    one_kind = spark.createDataFrame([("some text", 1)] * 9, "text string, toxic int")
    assert toxicity.fit(one_kind) is None and toxicity.fit(one_kind.where("false")) is None
    none = toxicity.classify(edge, labels.where("false")).collect()
    assert {(r["score"], r["predicted"]) for r in none} == {(0.0, 0)} and len(none) == edge.count()
    assert toxicity.classify(nothing, labels).collect() == []


def plain_toxicity(model, text):
    """Score of a text from one compression of every window by each dictionary."""
    def size(content, window):
        frame = toxicity._FRAME
        return len(toxicity._compressor(content).compress(window + frame))

    def joins(content, a, b):
        return (b" " + a)[-2:] + b" " + (b + b" ")[:2] in content

    stripped = [w.strip(b".,;:!?\"'()[]") for w in (text or "").lower().encode().split()]
    parts = [w for w in stripped if w]
    margins, hits = [], 0
    pairs = [(a, b) for a, b in zip(parts, parts[1:]) if joins(model.toxic, a, b)]
    for threshold, some in zip(model.thresholds, ([b" %b " % w for w in parts], [b" %b %b " % p for p in pairs])):
        gains = []
        for window in some:
            saved = size(model.ordinary, window) - size(model.toxic, window)
            gains.append(saved - model.discount * len(window) if saved > 0 else 0)
        margins.append(max([0, *gains]) - threshold)
        hits += sum(g >= threshold for g in gains)
    return 1 / (1 + math.exp(-(max(margins) + 0.1)) / math.sqrt(1 + hits))


def test_toxicity_scores_equal_plain_ones(spark, documents, toxic_model):
    chosen = documents.where("doc_id < 12").select("doc_id", "text").union(
        spark.createDataFrame([(-1, "you blockhead, blockhead of a day"), (-2, "one"), (-3, "..."), (-4, None)], "doc_id bigint, text string")
    )
    texts = {r["doc_id"]: r["text"] for r in chosen.collect()}
    for r in toxicity.score_documents(chosen, toxic_model).collect():
        assert r["score"] == pytest.approx(plain_toxicity(toxic_model, texts[r["doc_id"]]), rel=1e-9)
        assert r["predicted"] == (r["score"] >= 0.5)


def test_toxic_phrases_of_ordinary_words(spark):
    rng = random.Random(5)
    pool = [f"{a}{b}{c}" for a in ("ba", "ke", "lo", "mi", "tu") for b in ("rand", "sten", "goll", "pim") for c in ("", "er", "ing", "ous")]

    def text(phrase):
        body = rng.choices(pool, k=24)
        return " ".join([*body[:12], *phrase, *body[12:]])

    # Each word of the phrase is as common in ordinary texts as any other; only their order marks toxic ones.
    phrase = ["barand", "kesten", "logoll"]
    made = lambda n: ([text(phrase) for _ in range(n)], [text(rng.choices(pool, k=3)) for _ in range(2 * n)])
    model = toxicity.fit(labelled(spark, *made(240)))
    toxic, ordinary = made(80)
    assert np.mean([called(model, t) for t in toxic]) > 0.8
    assert np.mean([called(model, t) for t in ordinary]) < 0.1


def test_labelled_texts_are_whole_and_rows_bounded(spark):
    long = " ".join(f"long{k}" for k in range(30_000))
    docs = spark.createDataFrame([(0, long), (0, "z" + long), *((k, f"text {k}") for k in range(1, 4000)), (4000, " "), (None, "x")], "doc_id int, text string")
    labels = docs.where("doc_id is not null").select("doc_id", (F.col("doc_id") % 4 == 0).cast("int").alias("toxic")).distinct()
    every = toxicity.labelled_rows(docs, labels, toxic_rows=5000, ordinary_rows=5000).collect()
    assert len(every) == 4000 and long in {r["text"] for r in every}
    few = toxicity.labelled_rows(docs, labels, toxic_rows=7, ordinary_rows=20).groupBy("toxic").count().collect()
    assert {r["toxic"]: r["count"] for r in few} == {1: 7, 0: 20}


@pytest.mark.parametrize("n, similarity, want", [(10, 0.8, 2), (14, 0.8, 2), (15, 0.8, 3), (4, 0.8, 0), (20, 0.9, 2)])
def test_edits_allowed(n, similarity, want):
    assert decontaminate.edits_allowed(n, similarity) == want == math.floor((1 - similarity) * n + 1e-9)
