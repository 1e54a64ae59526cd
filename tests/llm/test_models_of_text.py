"""Whitening, the transducer and the conversation trie against plain versions."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from forecourt.llm import bpe_transducer as bpe
from forecourt.llm import prefix_trie, queries, whitening
from forecourt.llm.encoding import token_file
from tests.llm.conftest import rows
from tests.llm.test_tokens import ODD

WORD = token_file(queries.WORD_BPE)


# Whitening


def whitened_plainly(vectors, k=8):
    """n, S, deviations, |whitened| and shares with fractions for the covariance."""
    x = [[int(np.floor(1024 * float(c))) + 100_000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    sums = [sum(r[i] for r in x) for i in range(d)]
    centred = [[n * r[i] - sums[i] for i in range(d)] for r in x]
    v = np.array([[float(Fraction(sum(r[i] * r[j] for r in centred), n**3)) for j in range(d)] for i in range(d)])
    values, vectors = np.linalg.eigh(v)
    order = np.argsort(-values)[:k]
    white = np.array(centred, float) / n @ vectors[:, order] / np.sqrt(values[order])
    return [sum(c * c for c in r) for r in centred], np.abs(white), values[order] / np.trace(v)


def test_whitening_equals_a_plain_version(spark, folder):
    given_rows = {r["vec_id"]: r["embedding"] for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()}
    ids = sorted(given_rows)
    deviations, white, shares = whitened_plainly([given_rows[i] for i in ids])
    found = queries.whitened_embeddings(spark, folder)
    assert dict(found.dtypes)["deviation"] == "bigint" and dict(found.dtypes)["n"] == "bigint"
    got = {(r["vec_id"], r["component"]): r for r in found.collect()}
    assert len(got) == 8 * len(ids)
    for k, i in enumerate(ids):
        for c in range(1, 9):
            r = got[i, c]
            assert (r["n"], r["deviation"]) == (len(ids), deviations[k])
            assert abs(r["whitened"]) == pytest.approx(white[k, c - 1], rel=1e-6, abs=1e-7)
            assert r["explained"] == pytest.approx(shares[c - 1], rel=1e-9) and 0 <= r["identity_error"] < 1e-9
    table = np.array([[got[i, c]["whitened"] for c in range(1, 9)] for i in ids])
    assert np.allclose(table.T @ table / len(ids), np.eye(8), atol=1e-9)  # one sign for all rows


EDGE = "vec_id bigint, embedding array<float>, id string, vector int, n bigint, component int"


def test_whitening_of_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [
        (1, [0.5, -1.0, 2.0]), (2, [0.25, 3.0, 2.5]), (2, [0.25, 3.0, 2.5]), (None, [7.0, 0.0, -2.0]), (3, None), (4, []),
        (5, [1.0, None, 2.0]), (6, [nan, 1.0, 1.0]), (7, [inf, 1.0, 1.0]), (8, [1.0, -inf, 1.0]), (9, [1e5, -1e5, 0.0]), (10, [-0.0001, 0.0, 0.1]),
    ]
    df = spark.createDataFrame([(i, v, "x", 1, 2, 3) for i, v in vectors], EDGE).repartition(3)
    fine = [v for _, v in vectors if v and all(c is not None and np.isfinite(c) for c in v)]
    deviations, white, _ = whitened_plainly(np.array(fine, np.float32).tolist())
    got = whitening.whiten(df).collect()
    assert sorted({(r["vec_id"] or 0, int(r["deviation"])) for r in got}) == sorted({(i or 0, x) for i, x in zip([1, 2, 2, None, 9, 10], deviations)})
    assert len(got) == 18 and {r["n"] for r in got} == {6}
    assert sorted(abs(r["whitened"]) for r in got) == pytest.approx(sorted(white.ravel()), rel=1e-5, abs=1e-5)
    assert whitening.whiten(df.where("vec_id in (3, 4, 6)")).collect() == []
    assert whitening.whiten(df.where("vec_id = 1")).collect() == []  # one row has no variance
    flat = spark.createDataFrame([(k, [float(k), 1.0]) for k in range(9)], "vec_id bigint, embedding array<double>")
    assert {r["component"] for r in whitening.whiten(flat).collect()} == {1}
    with pytest.raises(Exception, match="one length"):
        whitening.whiten(spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], "vec_id bigint, embedding array<double>").coalesce(1)).collect()


@given(st.lists(st.lists(st.integers(-(2**40), 2**40), min_size=3, max_size=3), min_size=1, max_size=9))
@settings(max_examples=60, deadline=None)
def test_pair_sums_are_exact_for_large_numbers(values):
    x, centre = np.array(values, np.int64), np.array([5, -7, 2**39], np.int64)
    d = [[a - int(c) for a, c in zip(r, centre)] for r in values]
    want = [sum(r[i] ** 2 for r in d) for i in range(3)] + [sum((r[i] + r[j]) ** 2 for r in d) for i in range(3) for j in range(i + 1, 3)]
    assert [int(v) for v in whitening.pair_sums(x, centre)] == want


# BPE


@given(st.dictionaries(st.binary(max_size=6).filter(lambda b: 255 not in b), st.lists(st.integers(0, 65535), max_size=4).map(tuple), max_size=30), st.lists(st.binary(max_size=7), max_size=10))
@settings(max_examples=150, deadline=None)
def test_lexicon_is_the_mapping_it_was_compiled_from(tmp_path_factory, entries, others):
    path = tmp_path_factory.mktemp("lexicon") / "x.bin"
    path.write_bytes(bpe.compile_lexicon(entries.items()))
    words = [*entries, *(o for o in others if 255 not in o)]
    want = [np.array(entries[w], "<u2").tobytes() if w in entries else None for w in words]
    assert bpe.Lexicon(str(path)).find(words) == want


def test_lexicon_shares_endings(tmp_path):
    """Minimal: as many states as the words have different sets of endings with their outputs."""
    words = [a.encode() + b"ing" for a in "abcdefgh"] + [a.encode() + b"ed" for a in "abcdefgh"]
    (tmp_path / "x").write_bytes(bpe.compile_lexicon((w, (w[0],)) for w in words))
    found = bpe.Lexicon(str(tmp_path / "x"))
    # root, one state after any first letter, "i", "in", "e", and one that "ing" and "ed" share
    assert len({k >> 8 for k in found.keys.tolist()}) == 6
    assert len(found.flat) == 8


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(WORD)


def test_merges_equal_the_library(tokenizer, texts):
    merger, rnd = bpe.Merger(WORD), random.Random(4)
    letters = "aabcdehiinorst'.,1é日ß"
    made = ["".join(rnd.choice(letters) for _ in range(rnd.randint(1, 90))) for _ in range(1500)]
    for text in [*made, "x" * 5000, "ab" * 3000, "日本" * 400, *ODD]:
        got = []
        for piece in bpe.pieces_of(text):
            for w in merger.words(piece):
                got += [w] if isinstance(w, int) else merger.ids(w)
        want = tokenizer.encode(text, add_special_tokens=False).ids
        assert got == want
        assert merger.text(np.array(want, np.int64)) == tokenizer.decode(want, skip_special_tokens=False)


def digests(tokenizer, text):
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids
    back = tokenizer.decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()


def test_round_trip_of_documents(spark, folder, texts, tokenizer):
    found = rows(queries.transducer_round_trip(spark, folder))
    assert found == sorted(((i, *digests(tokenizer, t)) for i, t in texts.items()), key=repr)


@pytest.mark.parametrize("limit", [0, 5, 200_000])
def test_round_trip_of_edge_rows(edge, nothing, tokenizer, limit, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 20)
    odd = edge.unionByName(edge.sparkSession.createDataFrame([(100 + k, t) for k, t in enumerate(ODD)], "doc_id bigint, text string"), allowMissingColumns=True)
    found = bpe.encode_documents(odd, WORD, limit)
    got = sorted(((r["doc_id"] or -1, r["n"], r["h"]) for r in found.select("doc_id", (F.octet_length("ids") / 4).cast("int").alias("n"), F.sha2("ids", 256).alias("h")).collect()))
    assert got == sorted((r["doc_id"] or -1, *digests(tokenizer, r["text"])[:2]) for r in odd.collect())
    assert bpe.encode_documents(nothing, WORD, limit).collect() == []
    back = found.select("doc_id", bpe.decoded(WORD).alias("t"))
    assert sorted((r["doc_id"] or -1, hashlib.sha256(r["t"].encode()).hexdigest()) for r in back.collect()) == sorted(
        (r["doc_id"] or -1, digests(tokenizer, r["text"])[2]) for r in odd.collect())


def test_frequent_words_keep_to_the_bound(spark):
    counts = spark.createDataFrame([(bytes([65 + k]), n) for k, n in enumerate([9, 9, 5, 1, 1, 1])], "word binary, n bigint")
    sizes = {limit: bpe.frequent_words(counts, limit).count() for limit in (0, 1, 2, 3, 5, 6, 9)}
    assert sizes == {0: 0, 1: 0, 2: 2, 3: 3, 5: 3, 6: 6, 9: 6}


# Conversations


def trie_plainly(table):
    own = {}
    for c, _, role, text in sorted((r for r in table if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        own.setdefault(c, []).append((role or "", text or ""))
    members, ends = {}, {}
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 6
        path = tuple(own.get(c - c % 100, [])[:h] + own[c][h:])
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
        ends.setdefault(path, []).append(c)
    children, leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, who in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(who) - 1) * (len(node[-1][1]) if node else 0)
    return sorted((
        (who[0], len(node), members[node[:-1]][0] if node else None, len(who), children[node], leaves[node], saved[node],
         hashlib.sha256(",".join(map(str, ends.get(node, []))).encode()).hexdigest())
        for node, who in members.items()), key=repr)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
TURNS = "conv_id bigint, turn bigint, role string, text string"


def trie(df):
    return rows(prefix_trie.prefix_trie(df).select(*COLUMNS))


def test_trie_of_conversations(spark, folder):
    table = spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text")
    assert trie(table) == trie_plainly([tuple(r) for r in table.collect()])


def test_trie_of_long_and_odd_conversations(spark):
    rnd = random.Random(9)
    table = []
    for c in [0, 1, 2, 3, 7, 50, 99, 100, 101, 150, 205, 206, 10**12, 10**12 + 3]:
        for t in range(rnd.choice([1, 2, 8, 9, 16, 17, 24, 40, 70])):
            table.append((c, t, rnd.choice(["user", "user", None]), rnd.choice(["a", "a", "a", "", None, "é😀"])))
    table += [(300 + k, t, "user", "same") for k in range(40) for t in range(30)]
    table += [(5, None, "user", "first"), (5, 0, None, None), (6, 1, "user", "twice"), (6, 1, "user", "twice"), (None, 0, "user", "nobody"), (8, None, None, None)]
    df = spark.createDataFrame([(*r, k, "x", 1) for k, r in enumerate(table)], TURNS + ", level int, block string, pos int").repartition(5)
    assert trie(df) == trie_plainly(table)
    assert trie(df.limit(0)) == []
    assert trie(df.where("conv_id is null")) == []
