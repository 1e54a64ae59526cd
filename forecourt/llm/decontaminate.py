"""Benchmark passages in documents: CGK embedding, bit-sampling LSH and exact edit distances."""

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.llm.common import plain, text_key

#: Part of an item's words that must agree under edits, and the share of such windows to be found.
SIMILARITY, RECALL = 0.8, 0.99
#: Coordinates of the embedding that one table samples.
BITS = 4
#: Benchmark items that one pass over the documents takes; their words are held by every worker.
ITEMS = 4096
_EDGE = ".,;:!?\"'()[]|"
_REMEMBERED = 400_000
#: Most tables of one length. Items that need more are compared with every window that shares a run.
_MOST_TABLES = 256
#: Edited items of each length that its hit rate is measured with: first a few, then all.
_FEW, _ALL = 16, 128
_WINDOWS = 4096
_P = np.uint64(0x9E3779B97F4A7C15)


def normal(word: str) -> str:
    return word.strip(_EDGE)


def item_words(text: str | None) -> list[str]:
    return [w for w in map(normal, (text or "").lower().split()) if w]


def edits_allowed(n: int, similarity: float) -> int:
    return int((1 - similarity) * n + 1e-9)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _P
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def embed(ids: np.ndarray, starts: np.ndarray, n: int, tables: int, bits: int = BITS) -> np.ndarray:
    """Sampled CGK embeddings of the windows ``ids[start : start + n]``: hashes of shape (tables, windows).

    A walk stands on the first word of a window. Every step writes the word under it, then a random
    function of step and word says whether it goes on; behind the window there is padding. Two
    walks with the same randomness meet again soon after an edit, so windows at a small edit
    distance write sequences at a small Hamming distance. A table hashes ``bits`` of the
    2n places that the walk writes while it crosses the window, drawn at random.
    """
    rng = np.random.default_rng(1000 + n)
    steps = 2 * n
    seeds = rng.integers(1, 2**63, size=(tables, steps), dtype=np.uint64)
    taken = rng.integers(0, steps, size=(tables, bits))
    place = np.zeros((tables, len(starts)), np.int64)
    out = np.zeros((tables, len(starts)), np.uint64)
    limit = np.minimum(starts + n, len(ids))
    for step in range(int(taken.max()) + 1):
        at = starts + place
        word = np.where(at < limit, ids[np.minimum(at, len(ids) - 1)], np.uint64(1))
        for bit in range(bits):
            sampled = taken[:, bit] == step
            if sampled.any():
                out[sampled] = _mix(out[sampled] + word[sampled] * np.uint64(2 * bit + 3))
        place += (_mix(word ^ seeds[:, step, None]) >> np.uint64(63)).astype(np.int64)
    return out


def best_match(item: list, words: list) -> tuple[int, int, int]:
    """Least edit distance of ``item`` to any run of ``words``, with start and end of the run.

    Bit-parallel: one step per word, whatever the length of the item.
    """
    def search(pattern, text):
        masks = {}
        for k, w in enumerate(pattern):
            masks[w] = masks.get(w, 0) | 1 << k
        full, top = (1 << len(pattern)) - 1, 1 << (len(pattern) - 1)
        plus, minus, score, best = full, 0, len(pattern), (len(pattern), 0)
        for k, w in enumerate(text):
            eq = masks.get(w, 0)
            xv, xh = eq | minus, (((eq & plus) + plus) ^ plus) | eq
            ph, mh = minus | (full & ~(xh | plus)), plus & xh
            score += 1 if ph & top else -1 if mh & top else 0
            ph, mh = (ph << 1) & full, (mh << 1) & full
            plus, minus = mh | (full & ~(xv | ph)), ph & xv
            if score < best[0]:
                best = (score, k + 1)
        return best

    distance, end = search(item, words)
    back = search(item[::-1], words[:end][::-1])
    return distance, end - back[1], end


@dataclass
class Index:
    """What a worker needs to know of a block of benchmark items."""

    items: list[tuple]  # (item id, words as numbers)
    numbers: dict[str, int]
    grams: dict[int, np.ndarray]  # by the length of a run: hashes, items, places, sorted by hash
    tables: dict[int, int]  # by the length of an item; 0: more than are worth it, so all windows are compared
    similarity: float


def _grams(ids: np.ndarray, q: int) -> np.ndarray:
    out = np.zeros(max(0, len(ids) - q + 1), np.uint64)
    for k in range(q):
        out = _mix(out * _P + ids[k : len(ids) - q + 1 + k])
    return out


def run_length(n: int, similarity: float) -> int:
    """Words in a row that any window within the radius shares with the item: edits can't break all runs."""
    return max(1, n // (edits_allowed(n, similarity) + 1))


def _hit_rates(items: list[np.ndarray], similarity: float, samples: int, bits: int) -> np.ndarray:
    """Shares of the tables in which edited items of one length agree with their originals."""
    n = len(items[0])
    rng = np.random.default_rng([7, n, samples])
    q, edits = run_length(n, similarity), edits_allowed(n, similarity)
    before, whole, starts, owner, at = [], [], [], [], 0
    for k in range(samples):
        words = items[k % len(items)]
        edited = words.tolist()
        for _ in range(edits):
            place, kind = int(rng.integers(len(edited))), rng.integers(3)
            edited[place : place + (kind != 1)] = [] if kind == 2 and len(edited) > 1 else [int(rng.integers(2**62, 2**63))]
        mine, theirs = _grams(words, q), _grams(np.array(edited, np.uint64), q)
        shifts = {int(b) - a for a in range(len(mine)) for b in np.flatnonzero(theirs == mine[a])[:1]}
        # Foreign words around the edited item, so that no window reaches the next one.
        foreign = np.arange(2 * n, dtype=np.uint64) + np.uint64(2**60 + 2 * n * k)
        starts += [at + n + x for x in sorted(shifts)]
        owner += [k] * len(shifts)
        parts = foreign[:n], np.array(edited, np.uint64), foreign[n:]
        whole += parts
        at += sum(map(len, parts))
        before.append(words)
    own = embed(np.concatenate(before), np.arange(samples) * n, n, _MOST_TABLES, bits)
    whole, starts, owner = np.concatenate(whole), np.array(starts, np.int64), np.array(owner, np.int64)
    agree = np.zeros((_MOST_TABLES, samples), bool)
    for k in range(0, len(starts), 256):
        who = owner[k : k + 256]
        same = embed(whole, starts[k : k + 256], n, _MOST_TABLES, bits) == own[:, who]
        for j, sample in enumerate(who):
            agree[:, sample] |= same[:, j]
    return agree.mean(axis=0)


def tables_needed(items: list[np.ndarray], similarity: float, recall: float, bits: int = BITS) -> int:
    """Tables after which a window at the radius of items of one length is found with the wanted probability.

    Measured on the items themselves: they are edited as often as is allowed, by substitutions,
    insertions and deletions at random places, and the share of agreeing tables is counted,
    aligned at the runs of words that the edits left. The tables are independent, so the misses
    multiply; the mean of these probabilities must reach ``recall``. 0 if ``_MOST_TABLES`` don't.
    """
    if not edits_allowed(len(items[0]), similarity):
        return 1  # copies agree in every table
    reached = lambda rates, tables: np.mean(1 - (1 - rates) ** tables)
    # Far from the target with a few samples: no need for more.
    if reached(_hit_rates(items, similarity, _FEW, bits), _MOST_TABLES) < 1 - 5 * (1 - recall):
        return 0
    rates = _hit_rates(items, similarity, _ALL, bits)
    return next((t for t in range(1, _MOST_TABLES + 1) if reached(rates, t) >= recall), 0)


def build(rows: list[tuple], similarity: float = SIMILARITY, recall: float = RECALL) -> Index:
    numbers, items = {}, []
    for name, text in rows:
        words = item_words(text)
        if words:
            items.append((name, np.array([numbers.setdefault(w, len(numbers) + 2) for w in words], np.uint64)))
    by_run: dict[int, list] = {}
    for k, (_, words) in enumerate(items):
        q = run_length(len(words), similarity)
        codes = _grams(words, q)
        by_run.setdefault(q, []).append(np.stack([codes, np.full(len(codes), k, np.uint64), np.arange(len(codes), dtype=np.uint64)]))
    grams = {}
    for q, parts in by_run.items():
        table = np.concatenate(parts, axis=1)
        grams[q] = table[:, np.argsort(table[0], kind="stable")]
    by_length: dict[int, list] = {}
    for _, words in items:
        by_length.setdefault(len(words), []).append(words)
    tables = {n: tables_needed(group, similarity, recall) for n, group in sorted(by_length.items())}
    return Index(items, numbers, grams, tables, similarity)


class _Numbers(dict):
    """Numbers of words; 0 for a word of no item, and -1 for what holds no word."""

    def __init__(self, known: dict[str, int]):
        super().__init__()
        self.known = known

    def __missing__(self, raw: str) -> int:
        word = normal(raw)
        got = self.known.get(word, 0) if word else -1
        if len(self) < _REMEMBERED:
            self[raw] = got
        return got


class Finder:
    """Finds items in texts; the item embeddings are made once per worker and length."""

    def __init__(self, index: Index):
        self.index, self.numbers = index, _Numbers(index.numbers)
        self.codes: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def _items_of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n not in self.codes:
            own = [k for k, (_, w) in enumerate(self.index.items) if len(w) == n]
            words = np.concatenate([self.index.items[k][1] for k in own])
            self.codes[n] = np.array(own), embed(words, np.arange(len(own)) * n, n, self.index.tables[n])
        return self.codes[n]

    def _windows(self, ids: np.ndarray) -> tuple[dict[int, np.ndarray], np.ndarray]:
        """Windows that share a run of words with an item of their length.

        Starts by length, for the tables, and pairs of item and start where tables don't suffice.
        """
        found: dict[int, list] = {}
        direct = [np.zeros((0, 2), np.int64)]
        lengths = np.array([len(w) for _, w in self.index.items])
        for q, (codes, items, places) in self.index.grams.items():
            mine = _grams(ids, q)
            low = np.searchsorted(codes, mine)
            at = np.flatnonzero(codes[np.minimum(low, len(codes) - 1)] == mine) if len(mine) else []
            if not len(at):
                continue
            count = np.searchsorted(codes, mine[at], "right") - low[at]
            hit = np.repeat(low[at] - np.concatenate(([0], count.cumsum()[:-1])), count) + np.arange(count.sum())
            starts = np.repeat(at, count) - places[hit].astype(np.int64)
            which = items[hit].astype(np.int64)
            sizes = lengths[which]
            for n in np.unique(sizes):
                some = sizes == n
                if self.index.tables[int(n)]:
                    found.setdefault(int(n), []).append(starts[some])
                else:
                    direct.append(np.unique(np.stack((which[some], starts[some]), axis=1), axis=0))
        return {n: np.unique(np.concatenate(parts)) for n, parts in found.items()}, np.concatenate(direct)

    def find(self, texts: list[str | None]) -> list[tuple[int, int, int, int, int]]:
        """``(text, item, distance, start, end)``, the best window of each item in each text, in words."""
        raw = [np.fromiter(map(self.numbers.__getitem__, (t or "").lower().split()), np.int64) for t in texts]
        kept = [x[x >= 0] for x in raw]
        # The texts one after another, with more foreign words between them than any window is long.
        gap = np.zeros(max((len(w) for _, w in self.index.items), default=0) * 2 + 2, np.uint64)
        firsts, ids, at = [], [gap], len(gap)
        for x in kept:
            firsts.append(at)
            ids += [x.astype(np.uint64), gap]
            at += len(x) + len(gap)
        ids, firsts = np.concatenate(ids), np.array(firsts)
        best: dict[tuple[int, int], tuple[int, int, int]] = {}

        def verify(item: int, low: int, high: int) -> None:
            """Compare an item with the windows that start from ``low`` to ``high``, which lie in one text."""
            n = len(self.index.items[item][1])
            slack = edits_allowed(n, self.index.similarity)
            text = max(int(np.searchsorted(firsts, low + slack, "right")) - 1, 0)
            first = int(firsts[text])
            a, b = max(low - slack, first), min(high + n + slack, first + len(kept[text]))
            if a >= b:
                return
            distance, start, end = best_match(self.index.items[item][1].tolist(), ids[a:b].tolist())
            got = (distance, a + start - first, a + end - first)
            if distance <= slack and got < best.get((text, item), (n + 1,)):
                best[text, item] = got

        by_length, direct = self._windows(ids)
        for n, starts in by_length.items():
            own, theirs = self._items_of(n)
            for k in range(0, len(starts), _WINDOWS):
                part = starts[k : k + _WINDOWS]
                codes = embed(ids, part, n, self.index.tables[n])
                pairs = set()
                for mine, other in zip(theirs, codes):
                    order = np.argsort(mine, kind="stable")
                    low, high = (np.searchsorted(mine[order], other, side) for side in ("left", "right"))
                    for w in np.flatnonzero(high > low):
                        pairs.update((int(w), int(own[i])) for i in order[low[w] : high[w]])
                for w, item in pairs:
                    verify(item, int(part[w]), int(part[w]))
        if len(direct):
            # Windows of one item that lie close together are one stretch, so that a text is read once.
            item, start = direct[:, 0], direct[:, 1]
            reach = np.array([len(w) for _, w in self.index.items])[item]
            slack = np.array([edits_allowed(int(n), self.index.similarity) for n in reach])
            text = np.searchsorted(firsts, start + slack, "right")
            new = (np.diff(item) != 0) | (np.diff(text) != 0) | (np.diff(start) > reach[1:])
            edges = np.concatenate(([0], np.flatnonzero(new) + 1, [len(direct)]))
            for a, b in zip(edges, edges[1:]):
                verify(int(item[a]), int(start[a]), int(start[b - 1]))
        return [(text, item, *got) for (text, item), got in sorted(best.items())]


def find_items(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text: str = "text", similarity: float = SIMILARITY, recall: float = RECALL,
) -> DataFrame:
    """``(id, key, item, distance, start_word, end_word)``: the best window of every item in every text.

    An item of n words is found where a run of words is at most ``(1 - similarity) n`` word edits
    away; words are compared lower-cased and without punctuation at their ends. Windows of the
    item's length that share with it the run of words that so few edits must leave are embedded
    and looked up in sampled tables, as many as ``recall`` needs at that length; what they find is
    verified exactly. Where that were too many tables, all those windows are verified. Only texts pass through tasks: nothing is shuffled. The benchmark is a query
    set taken in blocks of ``ITEMS``, one pass over the documents for each.

    Null or empty texts hold nothing, null or empty items are held by nothing; repeated items are
    all reported, repeated rows too.
    """
    id_type, item_type = docs.schema[id_col].dataType.simpleString(), benchmark.schema[item_col].dataType.simpleString()
    items = benchmark.select(F.col(item_col).cast("string").alias("i"), F.col(item_text).cast("string").alias("t")).where("trim(t) != ''")
    blocks = max(1, -(-items.count() // ITEMS))
    numbered = items.withColumn("b", F.pmod(F.xxhash64("i", "t"), F.lit(blocks)))
    chosen = docs.select(F.col(id_col).cast("string").alias("id"), text_key(text_col).alias("key"), F.col(text_col).cast("string").alias("text"))
    out = None
    for block in range(blocks):
        rows = [(r["i"], r["t"]) for r in numbered.where(F.col("b") == block).orderBy("i", "t").collect()]
        found = _pass(chosen, build(rows, similarity, recall))
        out = found if out is None else out.union(found)
    return out.select(
        F.col("id").cast(id_type).alias(id_col), "key", F.col("item").cast(item_type).alias(item_col),
        "distance", "start_word", "end_word",
    )


def _pass(chosen: DataFrame, index: Index) -> DataFrame:
    shared = chosen.sparkSession.sparkContext.broadcast(index)

    def run(batches):
        finder = Finder(shared.value)
        for batch in batches:
            for at in range(0, len(batch), 1024):
                rows = batch.iloc[at : at + 1024]
                found = finder.find(rows["text"].tolist())
                which = [x[0] for x in found]
                yield pd.DataFrame({
                    "id": plain(rows["id"].to_numpy()[which]), "key": rows["key"].to_numpy()[which],
                    "item": plain([finder.index.items[x[1]][0] for x in found]), "distance": [x[2] for x in found],
                    "start_word": [x[3] for x in found], "end_word": [x[4] for x in found],
                })

    return chosen.mapInPandas(run, "id string, key bigint, item string, distance int, start_word bigint, end_word bigint")


def without_items(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options,
) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item. A row is known by its id and text."""
    found = find_items(docs, benchmark, id_col, text_col, **options)
    held = found.select(F.col(id_col).alias("__id"), F.col("key").alias("__key")).distinct()
    same = F.col(id_col).eqNullSafe(F.col("__id")) & (text_key(text_col) == F.col("__key"))
    return docs.join(held, same, "left_anti")
