"""SimHash groups and line dedup against plain versions."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash

from pyspark.sql import functions as F

from forecourt.llm import line_dedup, queries, simhash
from tests.llm.conftest import rows

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(_LOWER))
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))]
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64(s.encode(), seed=42).intdigest()
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def plain_components(pairs):
    """Pairs of id and fingerprint to the smallest id that links of at most three bits reach."""
    parent = list(range(len(pairs)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(pairs)):
        for b in range(a):
            if (pairs[a][1] ^ pairs[b][1]).bit_count() <= 3:
                parent[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(pairs):
        if i is not None:
            least[root(k)] = min(least.get(root(k), i), i)
    return [(i, f"{f:016x}", least.get(root(k))) for k, (i, f) in enumerate(pairs)]


def clustered(df):
    return [(r["doc_id"], f"{r['bits'] & (1 << 64) - 1:016x}", r["component"]) for r in simhash.clusters(df).collect()]


def test_clusters_of_documents(spark, folder, texts):
    want = plain_components([(i, plain_fingerprint(t)) for i, t in texts.items()])
    got = [tuple(r) for r in queries.simhash_clusters(spark, folder).select("doc_id", "fingerprint", "component_id").collect()]
    assert sorted(got) == sorted(want)


def test_clusters_of_edge_rows(edge, nothing):
    want = plain_components([(r["doc_id"], plain_fingerprint(r["text"])) for r in edge.collect()])
    assert sorted(clustered(edge), key=repr) == sorted(want, key=repr)
    assert clustered(nothing) == []


def test_representatives_keep_one_row_of_each_group(edge):
    kept = simhash.representatives(edge).collect()
    groups = {r["root"] for r in simhash.clusters(edge).collect()}
    assert len(kept) == len(groups)
    assert edge.columns == simhash.representatives(edge).columns


@pytest.mark.parametrize("size", [64, 100_000])
def test_links_connect_what_all_pairs_connect(spark, size):
    rnd = random.Random(3)
    codes = [rnd.getrandbits(64) for _ in range(600)]
    for _ in range(900):  # chains of near copies
        code = rnd.choice(codes)
        for _ in range(rnd.randint(1, 4)):
            code ^= 1 << rnd.randrange(64)
        codes.append(code)
    codes = list(dict.fromkeys(codes))
    signed = np.array(codes, np.uint64).view(np.int64).tolist()
    bits = spark.createDataFrame([(c,) for c in signed], "bits bigint")
    roots = {r["node"]: r["root"] for r in simhash.stars(simhash.link(bits, 3, (size, size))).collect()}
    found = {}
    for c in signed:
        found.setdefault(roots.get(c, c), set()).add(c)
    want = {}
    for (i, _, least), c in zip(plain_components(list(enumerate(codes))), signed):
        want.setdefault(least, set()).add(c)
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, want.values()))


def plain_lines(pairs, min_chars=40, min_docs=5):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(_LOWER)
    holders = {}
    for i, t in pairs:
        for line in (t or "").split("\n"):
            if i is not None and len(key(line)) >= min_chars:
                holders.setdefault(key(line), set()).add(i)
    out = []
    for i, t in pairs:
        lines = (t or "").split("\n")
        drop = [i is not None and len(holders.get(key(x), ())) >= min_docs and i != max(holders[key(x)]) for x in lines]
        kept = "\n".join(x for x, d in zip(lines, drop) if not d)
        out.append((i, len(lines), sum(drop), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def line_result(df):
    out = []
    for r in line_dedup.dedup_lines(df).collect():
        out.append((r["doc_id"], r["n_lines"], r["n_dropped"], hashlib.sha256((r["text"] or "").encode()).hexdigest()))
    return sorted(out, key=repr)


def test_lines_of_documents(spark, folder, texts):
    assert rows(queries.deduplicated_lines(spark, folder)) == plain_lines(texts.items())


def test_lines_of_edge_rows(edge, nothing):
    pairs = [(r["doc_id"], r["text"]) for r in edge.collect()]
    assert line_result(edge) == plain_lines(pairs)
    assert any(x[2] for x in line_result(edge))
    assert line_result(nothing) == []
    untouched = [r for r in line_dedup.dedup_lines(edge).collect() if r["doc_id"] == 1]
    assert untouched[0]["text"] is None


def test_bitmaps_over_several_words(spark):
    line = lambda k: f"line number {k} of quite some length, shared by all of them"
    texts = [(i, "\n".join(line(k) if k % 3 else f"own {i} {k}" for k in range(300))) for i in range(1, 7)]
    assert line_result(spark.createDataFrame(texts, "doc_id bigint, text string")) == plain_lines(texts)


def test_lines_of_a_result_and_clashing_columns(spark, edge, documents):
    """Line dedup runs on its own output, which then loses nothing, and on columns named like its own."""
    once = line_dedup.dedup_lines(documents)
    twice = line_dedup.dedup_lines(once)
    assert twice.columns == once.columns and twice.agg(F.sum("n_dropped")).first()[0] == 0
    assert rows(twice.drop("n_lines", "n_dropped")) == rows(once.drop("n_lines", "n_dropped"))
    odd = edge.withColumns({c: F.lit(7) for c in ("n_dropped", "n_lines", "__drops", "__id", "__dense", "last", "pos")})
    found = line_dedup.dedup_lines(odd)
    assert sorted(found.columns) == sorted(odd.columns)
    want = line_dedup.dedup_lines(edge).select("doc_id", "text", "n_lines", "n_dropped")
    assert rows(found.select("doc_id", "text", "n_lines", "n_dropped")) == rows(want)
    assert found.where("__drops <> 7 or pos <> 7").count() == 0
