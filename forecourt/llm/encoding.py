"""Whole texts to token ids, encoding every distinct piece of text once per worker."""

import re
from array import array

import numpy as np
from tokenizers import Tokenizer

#: Distinct pieces that a worker remembers: about 120 MB. Beyond them pieces are encoded per batch.
REMEMBERED = 600_000
AT_ONCE = 2_000_000
#: What a text must not hold to be cut: two white spaces together, white space other than these two, special tokens.
_UNSPLIT = ["  ", " \n", "\n ", "\n\n", "<|", *(c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n")]
#: A piece that is one run of Latin letters, perhaps with a full stop or comma behind it.
_PLAIN = re.compile(r"([ \n]?)([A-Za-zªµºÀ-ÖØ-öø-įı-ɏ]+)([.,]?)")


def _byte_letters() -> dict[int, str]:
    """How byte-level vocabularies write the 256 bytes: printable Latin-1 as itself, the others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = (b for b in range(256) if b not in set(plain))
    return {b: chr(b) for b in plain} | {b: chr(256 + n) for n, b in enumerate(others)}


_LETTERS = _byte_letters()

_encoders: dict[tuple[str, str, bool], "Encoder"] = {}


class Encoder:
    """Ids of whole texts as little-endian 16- or 32-bit arrays, equal to encoding each text at once.

    A text is cut only where its tokenizer always begins a new piece, whatever stands around:
    ``bytes``: a byte-level BPE whose pieces take at most one leading space; the cuts are before
    a single space and around a single line feed between other characters. Texts with runs of
    white space, other white space or something like a special token are encoded in one go.
    ``words``: a lower-casing tokenizer that drops white space; the cuts are ASCII white space.
    Pieces seen before come from memory. New ones go through the tokenizers library: a run of
    Latin letters, which no rule cuts, straight to its model, all others through the whole of it.
    With ``ordinary`` the strings of special tokens are ordinary text.
    """

    def __init__(self, path: str, kind: str, ordinary: bool = False):
        self.tokenizer, self.kind = Tokenizer.from_file(path), kind
        self.tokenizer.encode_special_tokens = ordinary
        self.model = self.tokenizer.model
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size(with_added_tokens=True) < 1 << 16 else "<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.known: dict = {}
        self.lengths: dict[str, int] = {}
        marks = [".", ",", "\n"]
        self.marks = dict(zip(marks, self._ids(marks))) | {"": b""}
        self.skip = len(self.marks["\n"]) // self.dtype.itemsize if kind == "bytes" else 0

    def _ids(self, pieces: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)
        return [array(self.code, x.ids).tobytes() for x in found]

    def _run(self, letters: str) -> bytes:
        if not letters.isascii() or letters[0] == " ":
            letters = letters.encode().decode("latin-1").translate(_LETTERS)
        return array(self.code, [x.id for x in self.model.tokenize(letters)]).tobytes()

    def _pieces(self, text: str) -> list:
        """Pieces as keys of memory; a line feed at the start of a key stands for itself, else there is a space."""
        if self.kind == "words":
            raw = text.encode("utf-8", "surrogatepass")
            return (raw if b"<|" in raw else raw.lower()).split()
        if any(x in text for x in _UNSPLIT) or text[-1:] in ("", " ", "\n") or text[0] in " \n":
            return [None]
        return ("\n" + text.replace("\n", " \n")).split(" ")

    def _learn(self, keys: list) -> dict:
        out, others = {}, {}
        for key in keys:
            if self.kind == "words":
                piece = key.decode("utf-8", "replace")
                if plain := _PLAIN.fullmatch(piece):
                    stem = key[:-1] if plain[3] else key
                    ids = self.known.get(stem) or out.get(stem) or self._run(plain[2].lower())
                    out[key] = ids + self.marks[plain[3]]
                    continue
            else:
                piece = key if key[0] == "\n" else " " + key
                if plain := _PLAIN.fullmatch(piece):
                    stem = key[:-1] if plain[3] else key
                    ids = self.known.get(stem) or out.get(stem)
                    if ids is None:
                        ids = self._run(" " + plain[2]) if plain[1] == " " else self.marks["\n"] + self._run(plain[2])
                    out[key] = ids + self.marks[plain[3]]
                    continue
            others[key] = piece
        return out | dict(zip(others, self._ids(list(others.values()))))

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of every text; a null text has none. Pieces of at most ``AT_ONCE`` characters, or of one text, are held."""
        out, held, size = [], [], 0
        for text in texts:
            held.append(text or "")
            size += len(held[-1])
            if size >= AT_ONCE:
                out += self._encode(held)
                held, size = [], 0
        return out + self._encode(held)

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        split = [self._pieces(t) for t in texts]
        raws = [self._joined(parts, self.known) for parts in split]
        missing = [i for i, raw in enumerate(raws) if raw is None]
        new = list(set().union(*(split[i] for i in missing)).difference(self.known, (None,)))
        table = self.known
        if new:
            ids = self._learn(new)
            if len(self.known) + len(new) <= REMEMBERED:
                self.known.update(ids)
            else:
                table = _Chained(self.known, ids)
        whole = iter(self._ids([texts[i] for i in missing if split[i] == [None]]))
        for i in missing:
            raws[i] = next(whole) if split[i] == [None] else self._joined(split[i], table)
        return [
            np.frombuffer(raw, self.dtype)[0 if parts == [None] else self.skip :] for raw, parts in zip(raws, split)
        ]

    @staticmethod
    def _joined(parts: list, table: dict) -> bytes | None:
        try:
            return b"".join(map(table.__getitem__, parts))
        except KeyError:
            return None

    def count(self, pieces: list[list[str]]) -> list[np.ndarray]:
        """Tokens of every pre-token, for a byte-level tokenizer; a pre-token is encoded as it stands."""
        new = list(set().union(*pieces).difference(self.lengths))
        table = self.lengths
        if new:
            runs = {x: len(self._run(x)) for x in new if (m := _PLAIN.fullmatch(x)) and m[1] != "\n" and not m[3]}
            others = [x for x in new if x not in runs]
            size = self.dtype.itemsize
            found = {x: n // size for x, n in runs.items()} | {x: len(b) // size for x, b in zip(others, self._ids(others))}
            if len(self.lengths) + len(found) <= REMEMBERED:
                self.lengths.update(found)
            else:
                table = _Chained(self.lengths, found)
        return [np.fromiter(map(table.__getitem__, x), np.int32, len(x)) for x in pieces]


class _Chained(dict):
    """What a batch adds, falling back on what is remembered."""

    def __init__(self, remembered: dict, added: dict):
        super().__init__(added)
        self.remembered = remembered

    def __missing__(self, key):
        return self.remembered[key]


def encoder(path: str, kind: str, ordinary: bool = False) -> Encoder:
    """The worker's encoder of a file and a setting, with its memory of pieces."""
    if (path, kind, ordinary) not in _encoders:
        _encoders[path, kind, ordinary] = Encoder(path, kind, ordinary)
    return _encoders[path, kind, ordinary]


def token_file(name: str) -> str:
    """Where a public tokenizer's file lies; the package is installed on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)
