"""BPE encoding and decoding with a minimal acyclic transducer over the corpus's frequent words."""

import heapq
import json
import mmap
import re
import uuid
from array import array
from collections import Counter
from collections.abc import Iterable

import numpy as np
import pandas as pd
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from forecourt.llm.common import plain, remove_at_exit, stored
from forecourt.session import shared_folder

#: Words in the lexicon at most, and their longest length in bytes: what bounds the automaton.
LEXICON, LONGEST = 200_000, 64
#: Distinct pieces that a worker remembers (about 80 MB), and characters that it encodes together.
REMEMBERED, AT_ONCE = 400_000, 1_000_000
#: Distinct words that a counting task holds before it hands them on.
HELD = 300_000
#: Ends every word in the automaton: a byte that UTF-8 never has.
END = 255
#: A piece of white-space-free text whose words the pattern below cuts as the tokenizer does.
_PLAIN = re.compile(r"[!-~À-ÖØ-öø-įı-ɏ]+")
#: How the tokenizer cuts normalised text into words. Fixed by the vocabulary.
_WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")


def byte_letters() -> list[str]:
    """How byte-level vocabularies write the 256 bytes: printable Latin-1 as itself, the others from U+0100 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


class Merger:
    """The tokenizer itself: words of a piece, exact merges of a word, and the tokens' strings."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        described = json.loads(self.tokenizer.to_str())
        model = described["model"]
        self.vocab, self.suffix = model["vocab"], model["end_of_word_suffix"] or ""
        pairs = (tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"])
        self.ranks = {pair: rank for rank, pair in enumerate(pairs)}
        self.letters = byte_letters()
        self.bytes = {letter: b for b, letter in enumerate(self.letters)}
        self.special = {t["content"]: t["id"] for t in described["added_tokens"]}
        self.specials = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.strings = [self.tokenizer.id_to_token(i) for i in range(self.tokenizer.get_vocab_size(True))]
        self.dtype = np.dtype("<u2" if len(self.strings) <= 1 << 16 else "<u4")

    def words(self, piece: bytes) -> list[bytes | int]:
        """UTF-8 words of a piece without white space; a special token is its id."""
        if piece.isalpha():  # letters of ASCII alone, perhaps with a full stop or comma behind them
            return [piece.lower()]
        if piece[-1:] in (b".", b",") and piece[:-1].isalpha():
            return [piece[:-1].lower(), piece[-1:]]
        text = piece.decode("utf-8", "replace")
        if b"<|" in piece and self.specials:
            out: list[bytes | int] = []
            for part in self.specials.split(text):
                out += [self.special[part]] if part in self.special else self._words(part)
            return out
        return self._words(text)

    def _words(self, text: str) -> list[bytes]:
        if _PLAIN.fullmatch(text):
            return [w.encode() for w in _WORD.findall(text.lower())]
        # Other letters: the library's own normaliser and cutter, which write bytes as letters.
        cut = self.tokenizer.pre_tokenizer.pre_tokenize_str(self.tokenizer.normalizer.normalize_str(text))
        return [bytes(map(self.bytes.__getitem__, w)) for w, _ in cut]

    def ids(self, word: bytes) -> list[int]:
        """Ids of a word by its vocabulary's merges: the lowest rank first, of equal ones the leftmost."""
        parts = [self.letters[b] for b in word]
        if not parts:
            return []
        parts[-1] += self.suffix
        if len(parts) > LONGEST:
            return [self.vocab[p] for p in self._merged_long(parts)]
        rank, none = self.ranks.get, len(self.ranks)
        pairs = [rank(pair, none) for pair in zip(parts, parts[1:])]
        while pairs and (best := min(pairs)) < none:
            i = pairs.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i < len(pairs):
                pairs[i] = rank((parts[i], parts[i + 1]), none)
            if i:
                pairs[i - 1] = rank((parts[i - 1], parts[i]), none)
        return [self.vocab[p] for p in parts]

    def _merged_long(self, parts: list[str | None]) -> list[str]:
        """The same with a heap of pairs over a linked list: n letters cost n log n."""
        n, ranks = len(parts), self.ranks
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(ranks[pair], i) for i, pair in enumerate(zip(parts, parts[1:])) if pair in ranks]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if parts[i] is None or j >= n or ranks.get((parts[i], parts[j])) != rank:
                continue  # one of the two has been merged with another meanwhile
            parts[i] += parts[j]
            parts[j] = None
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (found := ranks.get((parts[i], parts[k]))) is not None:
                    heapq.heappush(heap, (found, i))
            if (h := before[i]) >= 0 and (found := ranks.get((parts[h], parts[i]))) is not None:
                heapq.heappush(heap, (found, h))
        return [p for p in parts if p is not None]

    def text(self, ids: np.ndarray) -> str:
        """What the tokenizer, which has no decoder of its own, makes of ids: its tokens' strings with spaces between."""
        return " ".join(map(self.strings.__getitem__, ids.tolist()))


def compile_lexicon(entries: Iterable[tuple[bytes, tuple[int, ...]]], wide: bool = False) -> bytes:
    """A minimal acyclic transducer from distinct words to ids, as one flat file.

    Words are added in order, each with ``END`` behind it; a state that no later word can reach is replaced by an equal one
    that is there already, so common endings are shared. Outputs lie as near the start as all
    words through an arc allow. Arcs are sorted by (state, byte): a step is one binary search.
    """
    keys, targets, outputs = [], array("q"), []
    known: dict[tuple, int] = {}
    path: list[dict[int, list]] = [{}]  # per state on the current word's path: byte -> [output, target]
    last = b""
    frozen = 0

    def freeze(arcs: dict[int, list]) -> int:
        """The number of the state with these arcs, made if there is none yet."""
        nonlocal frozen
        shape = tuple((b, out, to) for b, (out, to) in arcs.items())
        state = known.get(shape)
        if state is None:
            state = known[shape] = frozen
            frozen += 1
            for b, out, to in shape:
                keys.append(state << 8 | b)
                targets.append(to)
                outputs.append(out)
        return state

    def close(depth: int) -> None:
        while len(path) > depth + 1:
            arcs = path.pop()
            path[-1][last[len(path) - 1]][1] = freeze(arcs)

    for word, ids in sorted((word + bytes([END]), ids) for word, ids in entries):
        shared = 0
        while shared < len(last) and word[shared] == last[shared]:
            shared += 1
        close(shared)
        for at in range(shared):
            arc = path[at][word[at]]
            both = 0
            while both < min(len(arc[0]), len(ids)) and arc[0][both] == ids[both]:
                both += 1
            rest, arc[0], ids = arc[0][both:], arc[0][:both], ids[both:]
            if rest:
                for below in path[at + 1].values():
                    below[0] = rest + below[0]
        for at in range(shared, len(word)):
            path[at][word[at]] = [ids if at == shared else (), -1]
            path.append({})
        last = word
    close(0)
    root = freeze(path[0])
    sizes = np.fromiter(map(len, outputs), np.int64, len(outputs))
    starts = np.concatenate(([0], sizes.cumsum())).astype(np.int64)
    flat = array("I" if wide else "H", [i for out in outputs for i in out])
    head = np.array([root, len(keys), len(flat), flat.itemsize], np.int64)
    return b"".join([head.tobytes(), np.array(keys, np.int64).tobytes(), targets.tobytes(), starts.tobytes(), flat.tobytes()])


class Lexicon:
    """A compiled lexicon, mapped into memory, so that the workers of a machine share its pages."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            raw = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        self.root, arcs, n, size = np.frombuffer(raw, np.int64, 4).tolist()
        self.keys = np.frombuffer(raw, np.int64, arcs, 32)
        self.targets = np.frombuffer(raw, np.int64, arcs, 32 + 8 * arcs)
        self.starts = np.frombuffer(raw, np.int64, arcs + 1, 32 + 16 * arcs)
        self.flat = np.frombuffer(raw, np.dtype(f"<u{size}"), n, 40 + 24 * arcs)

    def find(self, words: list[bytes]) -> list[bytes | None]:
        """The ids of every word as bytes, None for words that are not in the lexicon. All words walk together."""
        out: list[bytes | None] = [None] * len(words)
        if not words or not len(self.keys):
            return out
        letters = np.frombuffer(b"".join(w + bytes([END]) for w in words), np.uint8)
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
        begin = sizes.cumsum() - sizes
        alive = np.flatnonzero(sizes <= LONGEST + 1)
        state = np.full(len(words), self.root, np.int64)
        ended, who, arc = [], [], []
        for step in range(LONGEST + 1):
            if not len(alive):
                break
            key = state[alive] << 8 | letters[begin[alive] + step]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[at] == key
            alive, at = alive[hit], at[hit]
            state[alive] = self.targets[at]
            who.append(alive)
            arc.append(at)
            done = sizes[alive] == step + 1
            ended.append(alive[done])
            alive = alive[~done]
        found = np.zeros(len(words), bool)
        found[np.concatenate(ended)] = True
        who, arc = np.concatenate(who), np.concatenate(arc)
        keep = found[who]
        order = np.argsort(who[keep], kind="stable")
        who, arc = who[keep][order], arc[keep][order]
        count = self.starts[arc + 1] - self.starts[arc]
        total = count.cumsum()
        ids = self.flat[np.repeat(self.starts[arc] - total + count, count) + np.arange(total[-1] if len(total) else 0)]
        size = self.flat.itemsize
        raw, at = ids.tobytes(), 0
        mine = np.bincount(who, count, len(words)).astype(np.int64)
        for k in np.flatnonzero(found).tolist():
            out[k] = raw[at : at + int(mine[k]) * size]
            at += int(mine[k]) * size
        return out


class Coder:
    """Encodes texts: pieces from memory, words of new pieces from the lexicon, all other words by merging."""

    def __init__(self, tokenizer: str, lexicon: str):
        self.merger, self.lexicon = merger_of(tokenizer), Lexicon(lexicon)
        self.code = "H" if self.merger.dtype.itemsize == 2 else "I"
        self.known: dict[bytes, bytes] = {}

    def _learn(self, pieces: list[bytes]) -> dict[bytes, bytes]:
        cut = [self.merger.words(p) for p in pieces]
        words = list({w for parts in cut for w in parts if isinstance(w, bytes)})
        ids: dict[bytes | int, bytes] = dict(zip(words, self.lexicon.find(words)))
        for word, found in ids.items():
            if found is None:
                ids[word] = array(self.code, self.merger.ids(word)).tobytes()
        ids |= {i: array(self.code, [i]).tobytes() for i in self.merger.special.values()}
        return {p: b"".join(map(ids.__getitem__, parts)) for p, parts in zip(pieces, cut)}

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of every text as 16- or 32-bit numbers; a null text has none."""
        out, held, size = [], [], 0
        for text in texts:
            held.append(pieces_of(text))
            size += len(text or "")
            if size >= AT_ONCE:
                out += self._joined(held)
                held, size = [], 0
        return out + self._joined(held)

    def _joined(self, split: list[list[bytes]]) -> list[bytes]:
        new = list(set().union(*split).difference(self.known))
        added = self._learn(new)
        if len(self.known) + len(added) <= REMEMBERED:
            self.known.update(added)
            added = {}
        get = self.known.__getitem__ if not added else (lambda p: self.known[p] if p in self.known else added[p])
        return [b"".join(map(get, parts)) for parts in split]


def pieces_of(text: str | None) -> list[bytes]:
    """White-space-free pieces of a text in lower-case ASCII, for a tokenizer that drops ASCII white space.

    Where something like a special token stands, case is kept: special tokens have one.
    """
    raw = (text or "").encode("utf-8", "surrogatepass")
    return (raw if b"<|" in raw else raw.lower()).split()


_coders: dict[tuple[str, str], Coder] = {}


def coder(tokenizer: str, lexicon: str) -> Coder:
    """The worker's coder of a tokenizer and a shipped lexicon, with its memory of pieces."""
    if (tokenizer, lexicon) not in _coders:
        _coders.clear()  # a worker serves one corpus at a time
        _coders[tokenizer, lexicon] = Coder(tokenizer, SparkFiles.get(lexicon))
    return _coders[tokenizer, lexicon]


_mergers: dict[str, Merger] = {}


def merger_of(tokenizer: str) -> Merger:
    """The worker's merger of a file."""
    if tokenizer not in _mergers:
        _mergers[tokenizer] = Merger(tokenizer)
    return _mergers[tokenizer]


def count_words(docs: DataFrame, tokenizer: str, text_col: str = "text") -> DataFrame:
    """``(word, n)``: how often every word stands in the texts, as UTF-8 bytes.

    Pieces are counted first, so that every distinct piece is cut into words once. A task holds about ``HELD`` of either.
    """

    def table(counted: Counter, name: str) -> pd.DataFrame:
        out = pd.DataFrame({name: list(counted), "n": np.fromiter(counted.values(), np.int64, len(counted))})
        counted.clear()
        return out

    def pieces(batches):
        seen = Counter()
        for batch in batches:
            for text in batch["text"]:
                seen.update(pieces_of(text))
                if len(seen) > HELD:
                    yield table(seen, "piece")
        yield table(seen, "piece")

    def words(batches):
        merger, seen = merger_of(tokenizer), Counter()
        for batch in batches:
            for piece, n in zip(batch["piece"], batch["n"].tolist()):
                for word in merger.words(piece):
                    if isinstance(word, bytes) and len(word) <= LONGEST:
                        seen[word] += n
            if len(seen) > HELD:
                yield table(seen, "word")
        yield table(seen, "word")

    cut = docs.select(F.col(text_col).cast("string").alias("text")).mapInPandas(pieces, "piece binary, n bigint")
    counted = cut.groupBy("piece").agg(F.sum("n").alias("n")).mapInPandas(words, "word binary, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(counts: DataFrame, limit: int) -> DataFrame:
    """The words above the lowest count with which at most ``limit`` words remain.

    The border is taken from a histogram of counts on a fine logarithmic scale, so no word is
    sorted or gathered to find it.
    """
    level = F.floor(F.log2("n") * 64)
    sizes = counts.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("words")).orderBy(F.desc("level")).collect()
    border, total = None, 0
    for row in sizes:
        total += row["words"]
        if total > limit:
            break
        border = row["level"]
    return counts.where(level >= F.lit(border)) if border is not None else counts.where(F.lit(False))


def build_lexicon(docs: DataFrame, tokenizer: str, limit: int = LEXICON, text_col: str = "text") -> bytes:
    """The compiled lexicon of a corpus's most frequent words, at most ``limit``.

    All texts are counted and the words merged on the executors; the driver compiles what that
    bound lets through: 200,000 words are about 6 MB, and so is their automaton. An empty corpus
    gives an automaton without arcs.
    """

    def run(batches):
        merger = merger_of(tokenizer)
        for batch in batches:
            ids = [array("I", merger.ids(w)).tobytes() for w in batch["word"]]
            yield pd.DataFrame({"word": batch["word"], "ids": ids})

    counts = stored(count_words(docs, tokenizer, text_col), "word-counts")
    table = frequent_words(counts, limit).select("word").mapInPandas(run, "word binary, ids binary").toArrow()
    entries = zip(table["word"].to_pylist(), table["ids"].to_pylist())
    wide = Tokenizer.from_file(tokenizer).get_vocab_size(with_added_tokens=True) > 1 << 16
    return compile_lexicon(((w, tuple(array("I", ids))) for w, ids in entries), wide)


def ship(spark: SparkSession, raw: bytes) -> str:
    """Write a lexicon to the shared folder and have Spark bring it to every executor; its name there."""
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    path = f"{shared_folder(spark).rstrip('/')}/{name}"
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = place.getFileSystem(spark._jsc.hadoopConfiguration()).create(place)
    out.write(bytearray(raw))
    out.close()
    remove_at_exit(spark, path)
    spark.sparkContext.addFile(path)
    return name


def encode_documents(
    docs: DataFrame, tokenizer: str, limit: int = LEXICON, id_col: str = "doc_id", text_col: str = "text", decode: bool = False,
) -> DataFrame:
    """``(id, ids)`` per row: the ids of the whole text as little-endian 32-bit numbers.

    With ``decode`` also ``decoded``, the text that the ids give back, made where they are.

    They are those of the tokenizers library without special tokens added, truncation or padding;
    a special token's string in a text is that token. The tokenizer drops white space, lower-cases
    and ends words. A null or empty text has no ids, a row without an id and repeated rows have a
    row each, other columns are left out, an empty table gives none.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    name = ship(docs.sparkSession, build_lexicon(docs, tokenizer, limit, text_col))

    def run(batches):
        mine = coder(tokenizer, name)
        for batch in batches:
            for at in range(0, len(batch), 256):
                rows = batch.iloc[at : at + 256]
                found = [np.frombuffer(raw, mine.merger.dtype) for raw in mine.encode(rows["text"].tolist())]
                out = pd.DataFrame({"id": plain(rows["id"]), "ids": [ids.astype("<u4").tobytes() for ids in found]})
                yield out.assign(decoded=list(map(mine.merger.text, found))) if decode else out

    chosen = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"))
    made = chosen.mapInPandas(run, "id string, ids binary" + ", decoded string" * decode)
    return made.select(F.col("id").cast(id_type).alias(id_col), *made.columns[1:])


def decoded(tokenizer: str, ids: str = "ids") -> F.Column:
    """The text of a column of stored ids, as the tokenizers library decodes them, special tokens included."""

    @F.pandas_udf("string")
    def text(column: pd.Series) -> pd.Series:
        return column.map(lambda raw: merger_of(tokenizer).text(np.frombuffer(raw, "<u4")))

    return text(ids)
