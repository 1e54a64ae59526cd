"""Encoders, token files, packing and edited counts against whole encodings."""

import functools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from forecourt.llm import packing, queries, token_counts, token_files
from forecourt.llm.encoding import Encoder, token_file
from tests.llm.conftest import rows

ODD = [
    "", " ", "a", " a", "a ", "\n", "a\n", "a\nb", "a \nb", "a\n b", "a  b", "a\n\nb", "a\tb", "a 's b", "don't 'll", "ΣΑΣ İI",
    "<|endoftext|> a", "a<|endoftext|>b c", "a\x1cb c", "\x85 a", "1234 5,6 ...", "a\r\nb", "a b", "a　b", "́a b", "Å B",
    "日本 語\n行", "a_b <|STARTOFTEXT|>x", "ǅ ß ẞ", "Å é",
]


@functools.cache
def tokenizer(name, special):
    found = Tokenizer.from_file(token_file(name))
    found.encode_special_tokens = special
    return found


def ids_of(name, text, special=False):
    return tokenizer(name, special).encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("name, kind", [(queries.WORD_BPE, "words"), (queries.BYTE_BPE, "bytes")])
def test_pieces_encode_as_whole_texts_do(name, kind, texts):
    batch = [*texts.values(), *ODD, None]
    coder = Encoder(token_file(name), kind)
    whole = [x.ids for x in coder.tokenizer.encode_batch([t or "" for t in batch], add_special_tokens=False)]
    for _ in range(2):  # first new to the encoder, then remembered
        assert [x.tolist() for x in coder.encode(batch)] == whole


@pytest.mark.parametrize("name, kind", [(queries.WORD_BPE, "words"), (queries.BYTE_BPE, "bytes")])
def test_a_full_memory_changes_nothing(name, kind, texts, monkeypatch):
    monkeypatch.setattr("forecourt.llm.encoding.REMEMBERED", 50)
    batch = list(texts.values())[:40]
    coder = Encoder(token_file(name), kind)
    got = [x.tolist() for k in range(0, 40, 7) for x in coder.encode(batch[k : k + 7])]
    assert got == [x.ids for x in coder.tokenizer.encode_batch(batch, add_special_tokens=False)]


@pytest.mark.parametrize("ids", [[], [0], [255, 256], list(range(0, 200_000, 7)), [2**24 + 5] * 1500 + [3] * 1100])
def test_codes_round_trip_and_random_access(ids):
    code = token_files.pack(np.array(ids, np.uint32))
    assert token_files.unpack(code).tolist() == ids
    places = np.array(sorted(random.Random(1).sample(range(len(ids)), min(len(ids), 700))), np.int64)
    assert token_files.token_at(code, places).tolist() == [ids[k] for k in places]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_files_of_documents(spark, folder, texts):
    want, before = [], 0
    for i in sorted(texts):
        ids = ids_of(queries.WORD_BPE, texts[i]) + [2]
        want.append((i, before, len(ids), crc(ids)))
        before += len(ids)
    assert rows(queries.token_id_files(spark, folder)) == sorted(want, key=repr)


def test_token_files_of_edge_rows(spark, edge, nothing, tmp_path, monkeypatch):
    monkeypatch.setattr("forecourt.llm.token_files.SEGMENT", 1000)
    path = str(tmp_path / "tokens")
    token_files.write_tokens(edge, path, token_file(queries.WORD_BPE), "words", 2)
    got = sorted(((r["start"], r["doc_id"], np.frombuffer(r["ids"], "<u4").tolist()) for r in token_files.read_tokens(spark, path).collect()))
    names = [x[1] for x in got]
    assert names == sorted(names, key=lambda i: (i is not None, i or 0))
    want = sorted((r["doc_id"] or -1, ids_of(queries.WORD_BPE, r["text"]) + [2]) for r in edge.collect())
    assert sorted((i or -1, ids) for _, i, ids in got) == want
    flat = [x for _, _, ids in got for x in ids]
    assert [s for s, _, _ in got] == np.cumsum([0] + [len(x[2]) for x in got])[:-1].tolist()
    asked = spark.createDataFrame([(k,) for k in [0, 5, len(flat) - 1, len(flat), -1, len(flat) // 2]], "position bigint")
    assert rows(token_files.read_positions(spark, path, asked)) == sorted(((k, flat[k]) for k in {0, 5, len(flat) - 1, len(flat) // 2}), key=repr)
    token_files.write_tokens(nothing, path + "0", token_file(queries.WORD_BPE), "words", 2)
    assert token_files.read_tokens(spark, path + "0").collect() == []


def check_packing(found, texts, capacity=2048):
    by_doc, by_sequence = {}, {}
    for r in found:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for i, text in texts.items():
        ids = ids_of(queries.BYTE_BPE, text) + [0]
        parts = sorted(by_doc.pop(i), key=lambda r: r["piece"])
        assert [p["piece"] for p in parts] == list(range(len(parts)))
        assert all(p["length"] == capacity for p in parts[1:])
        at = 0
        for p in parts:
            assert p["start"] == at and p["ids_crc32"] == crc(ids[at : at + p["length"]])
            at += p["length"]
        assert at == len(ids)
    assert not by_doc
    for parts in by_sequence.values():
        at = 0
        for p in sorted(parts, key=lambda r: r["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= capacity
    total = sum(r["length"] for r in found)
    assert len(by_sequence) <= -(-total // capacity) * 1.01 + 1


def test_packing_of_documents(spark, folder, texts):
    check_packing(queries.best_fit_packing(spark, folder).collect(), texts)


def test_packing_of_edge_rows(edge, nothing):
    odd = edge.where("doc_id is null or doc_id not in (5, 14)").dropDuplicates(["doc_id"])
    check_packing(queries.packed(odd).collect(), {r["doc_id"]: r["text"] for r in odd.collect()})
    assert queries.packed(edge).where("doc_id = 5").count() == 2
    assert queries.packed(nothing).collect() == []


def test_sequences_hold_their_pieces(documents):
    found = packing.pack_documents(documents, token_file(queries.BYTE_BPE), max_docs=3)
    whole = packing.sequences(found).collect()
    assert max(r["n_docs"] for r in whole) <= 3
    assert sum(len(r["ids"]) // 2 for r in whole) == found.agg(F.sum("length")).first()[0]


@pytest.mark.parametrize("by", ["norm", "dot"])
def test_best_fit_keeps_every_limit(by):
    lengths = np.random.default_rng(2).integers(1, 100, 800)
    limits = (100, 4, 5000) if by == "norm" else (100, 4, 10_000)
    lengths = np.minimum(lengths, 70)
    bins, offsets = packing.best_fit(lengths, limits, (1.0, 0.5, 0.5), by)
    for b in np.unique(bins):
        mine = lengths[bins == b]
        assert mine.sum() <= limits[0] and len(mine) <= limits[1] and (mine**2).sum() <= limits[2]
        order = np.argsort(offsets[bins == b])
        assert offsets[bins == b][order].tolist() == (mine[order].cumsum() - mine[order]).tolist()


def test_recounting_equals_counting_anew(monkeypatch):
    monkeypatch.setattr(token_counts, "LEAF", 3)
    coder = Encoder(token_file(queries.BYTE_BPE), "bytes", ordinary=True)
    count = lambda parts: int(coder.count([parts])[0].sum())
    rnd = random.Random(1)
    letters = ["a", "b", " ", " ", "\n", "'s", "1", "23", ".", "é", "  ", "\t", "ab cd", "<|endoftext|>", "   "]
    for _ in range(1500):
        text = "".join(rnd.choice(letters) for _ in range(rnd.randint(0, 120)))
        parts = token_counts.PRE_TOKEN.findall(text)
        ends, sums = token_counts.leaves(text, coder.count([parts])[0], np.fromiter(map(len, parts), np.int64, len(parts)))
        heap = token_counts.tree(sums)
        for _ in range(2):
            at, edits, want, done = sorted(rnd.randint(0, len(text)) for _ in range(6)), [], "", 0
            for a, b in zip(at[::2], at[1::2]):
                if not edits or a > edits[-1][1]:
                    edits.append((a, b, "".join(rnd.choice(letters) for _ in range(rnd.randint(0, 4)))))
            for a, b, new in edits:
                want, done = want + text[done:a] + new, b
            want += text[done:]
            text, ends, heap, _ = token_counts.recount(text, ends, heap, edits, count)
            assert text == want
            assert heap[1] == len(ids_of_cached(coder, text)) and (ends[-1:] == len(text)).all()


def ids_of_cached(coder, text):
    return coder.tokenizer.encode(text, add_special_tokens=False).ids


def test_counts_of_documents(spark, folder, texts, edge, nothing):
    import re

    def want(pairs):
        out = []
        for i, t in pairs:
            masked, n = re.subn(queries.DIGITS, queries.DIGIT_MARK, t or "")
            out.append((i, len(ids_of(queries.BYTE_BPE, t, True)), n, len(ids_of(queries.BYTE_BPE, masked, True))))
        return sorted(out, key=repr)

    found = queries.edited_token_counts(spark, folder)
    assert rows(found.drop("n_encoded")) == want(texts.items())
    assert found.where("n_edits > 0").count() > 3
    big = found.where("n_edits = 1 and n_tokens > 3000").collect()
    assert all(r["n_encoded"] < 2000 for r in big)
    after = token_counts.counts_after(edge, token_file(queries.BYTE_BPE), "w", "--").drop("n_encoded")
    assert after.count() == edge.count()
    plain = token_counts.counts_after(edge, token_file(queries.BYTE_BPE), queries.DIGITS, queries.DIGIT_MARK)
    assert rows(plain.drop("n_encoded")) == want([(r["doc_id"], r["text"]) for r in edge.collect()])
    assert token_counts.counts_after(nothing, token_file(queries.BYTE_BPE), "x", "y").collect() == []


def test_rows_without_an_id_are_edited(spark):
    texts = [(None, "call 1234567 now"), (None, "or 7654321 and 1111111"), (None, "never"), (1, "call 1234567 now"), (1, None)]
    docs = spark.createDataFrame([*texts, texts[0]], "doc_id bigint, text string")
    found = token_counts.counts_after(docs, token_file(queries.BYTE_BPE), queries.DIGITS, queries.DIGIT_MARK)
    size = lambda t: len(ids_of(queries.BYTE_BPE, t, True))
    want = []
    for i, t in [*texts, texts[0]]:
        masked = (t or "").replace("1234567", "<number>").replace("7654321", "<number>").replace("1111111", "<number>")
        want.append((i, size(t or ""), masked.count("<number>"), size(masked)))
    assert rows(found.drop("n_encoded")) == sorted(want, key=repr)


def test_packing_after_counting_in_one_session(spark):
    """Counting takes special tokens' strings as text, packing as tokens, in the same workers."""
    text = "hello <|endoftext|> world 1234567"
    docs = spark.createDataFrame([(k, text) for k in range(40)], "doc_id bigint, text string").repartition(8)
    counted = token_counts.counts_after(docs, token_file(queries.BYTE_BPE), queries.DIGITS, queries.DIGIT_MARK)
    for _ in range(2):
        assert {r["n_tokens"] for r in counted.collect()} == {len(ids_of(queries.BYTE_BPE, text, True))}
        check_packing(queries.packed(docs).collect(), dict.fromkeys(range(40), text))


def test_counting_shuffles_edited_texts_only(spark, folder, monkeypatch):
    kept = []
    real = token_counts.apply_edits
    monkeypatch.setattr(token_counts, "apply_edits", lambda trees, edits, *more: kept.append((trees, edits)) or real(trees, edits, *more))
    queries.edited_token_counts(spark, folder)
    trees, edits = kept[0]
    assert 0 < trees.count() == edits.count() < 0.3 * spark.read.parquet(f"{folder}/documents.parquet").count()
