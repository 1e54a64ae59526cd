"""Toxicity by compression distance: which of two trained zstandard dictionaries explains a window better."""

import math
import random
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.llm.common import plain
from forecourt.session import checkpoint

#: Most rows of either label that a model is fitted on.
TOXIC_ROWS, ORDINARY_ROWS = 1500, 4500
#: Distinct windows that a worker remembers.
REMEMBERED = 600_000
_EDGE = b".,;:!?\"'()[]"
#: A run that both dictionaries hold. Behind a window it makes even a short one worth compressing.
_FRAME = bytes([*range(1, 9), *range(14, 22)]) * 2
#: Bytes of the ordinary dictionary, and about as many of samples to train it on.
_BASE, _SAMPLES = 1 << 16, 16 << 20
#: Windows that the toxic dictionary is trained on, discounts to try, and misses that a false alarm counts for.
_CHOICES, _DISCOUNTS, _ALARM = (4, 64, 256, 1024), (0.0, 0.15, 0.3), 3
_STEPS = np.arange(1, 16.25, 0.25)


def words(text: str | None) -> list[bytes]:
    """The words of a text, lower-cased, without punctuation at their ends."""
    raw = (text or "").lower().encode("utf-8", "surrogatepass").split()
    return [w for w in (x.strip(_EDGE) for x in raw) if w]


def _junction(left: bytes, right: bytes) -> bytes:
    """The five bytes in which two words meet, the shortest match of the compressor."""
    return (b" " + left)[-2:] + b" " + (right + b" ")[:2]


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    plain = zstandard.ZstdCompressionParameters(
        min_match=5, strategy=zstandard.STRATEGY_LAZY2, window_log=17, hash_log=16, chain_log=16, search_log=8,
        target_length=64, write_checksum=False, write_content_size=False, write_dict_id=False,
        format=zstandard.FORMAT_ZSTD1_MAGICLESS,
    )
    raw = zstandard.ZstdCompressionDict(content + _FRAME, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(dict_data=raw, compression_params=plain)


@dataclass(frozen=True)
class Model:
    """The two dictionaries, and what a window of each size must gain for a text to be called toxic.

    A gain is the bytes that the toxic dictionary saves less ``discount`` for each byte of the window.
    """

    ordinary: bytes
    toxic: bytes
    thresholds: tuple[float, ...]
    discount: float


class Distances:
    """Bytes of windows that the toxic dictionary saves: the ordinary one's length less the toxic one's."""

    def __init__(self, ordinary: bytes, toxic: bytes):
        self.ordinary, self.toxic = _compressor(ordinary), _compressor(toxic)
        self.joined = {toxic[k : k + 5] for k in range(len(toxic) - 4) if toxic[k + 2 : k + 3] == b" "}
        self.known: dict[bytes, int] = {}

    def windows(self, parts: list[bytes]) -> tuple[list[bytes], list[bytes]]:
        """Every word, and every two words that the toxic dictionary joins.

        Where it holds nothing across two words it can't explain them better than one by one.
        """
        pairs = [b" " + a + b" " + b + b" " for a, b in zip(parts, parts[1:]) if _junction(a, b) in self.joined]
        return [b" " + w + b" " for w in parts], pairs

    def _saved(self, window: bytes) -> int:
        if window in self.known:
            return self.known[window]
        saved = len(self.ordinary.compress(window + _FRAME)) - len(self.toxic.compress(window + _FRAME))
        if len(self.known) < REMEMBERED:
            self.known[window] = saved
        return saved

    def saved(self, text: str | None) -> list[tuple[np.ndarray, np.ndarray]]:
        """Bytes saved and bytes in all windows of a text: its words, then its pairs."""
        found = self.windows(words(text))
        return [(np.array([self._saved(w) for w in some], float), np.array([len(w) for w in some], float)) for some in found]

    def gains(self, text: str | None, discount: float) -> list[np.ndarray]:
        """Gains of the windows of a text, by size; windows that save nothing gain nothing."""
        return [np.where(saved > 0, saved - discount * sizes, 0.0) for saved, sizes in self.saved(text)]


def _trained(samples: list[bytes], size: int, **options) -> bytes:
    """The content of a dictionary that zstandard trains on the samples; all of them if they are too few."""
    try:
        return zstandard.train_dictionary(size, samples, **options).as_bytes()[-size:]
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def _toxic_dictionary(marked: list[tuple[bytes, int]]) -> bytes:
    """Trained on windows that mark toxic text, each as often as it has neighbourhoods, in mixed order."""
    samples = [b" " + w + b" " for w, k in marked for _ in range(min(k, 50))]
    random.Random(7).shuffle(samples)
    samples = [b"".join(samples[k : k + 4]) for k in range(0, len(samples), 4)]
    return _trained(samples, max(256, 2 * sum(len(w) + 2 for w, _ in marked)), k=24, d=6, f=20, accel=1)


def _neighbourhoods(rows: DataFrame) -> DataFrame:
    """``(window, more, less)``: in how many different neighbourhoods a window of one or two words
    occurs in toxic and in ordinary texts, so that copies of a text count once."""

    def run(batches):
        for batch in batches:
            for text, toxic in zip(batch["text"], batch["toxic"]):
                parts = [b"", *words(text), b""]
                some = {(b" ".join(parts[k : k + n]), parts[k - 1] + b"\n" + parts[k + n]) for n in (1, 2) for k in range(1, len(parts) - n)}
                yield pd.DataFrame({"window": [w for w, _ in some], "beside": [c for _, c in some], "toxic": toxic})

    seen = rows.select("text", "toxic").mapInPandas(run, "window binary, beside binary, toxic int")
    seen = seen.select("window", F.xxhash64("beside").alias("beside"), "toxic").distinct()
    return seen.groupBy("window").agg(F.sum("toxic").alias("more"), F.sum(1 - F.col("toxic")).alias("less"))


def _marked(rows: DataFrame, most: int) -> list[tuple[bytes, int]]:
    """At most ``most`` windows that mark toxic text, the strongest last, with their neighbourhoods."""
    counts = checkpoint(_neighbourhoods(rows))
    n_more, n_less = counts.agg(F.sum("more"), F.sum("less")).first()
    odds = (F.col("more") / F.lit(max(1, n_more or 0))) / ((F.col("less") + 1) / F.lit(max(1, n_less or 0)))
    strong = counts.where((F.col("more") >= 3) & (odds > 3)).withColumn("weight", F.col("more") * F.log(odds))
    top = strong.orderBy(F.col("weight").desc(), F.col("window").desc()).limit(most).collect()
    return [(bytes(r["window"]), int(r["more"])) for r in reversed(top)]


def _ordinary_dictionary(rows: DataFrame) -> bytes:
    """Trained on windows of 24 words of ordinary texts, drawn by a hash where they exceed ``_SAMPLES`` bytes."""
    ordinary = rows.where("toxic = 0")
    total = ordinary.agg(F.sum(F.octet_length("text"))).first()[0] or 0

    def run(batches):
        for batch in batches:
            for text in batch["text"]:
                parts = words(text)
                yield pd.DataFrame({"window": [b" " + b" ".join(parts[k : k + 24]) + b" " for k in range(0, len(parts), 24)]})

    parts = ordinary.select("text").mapInPandas(run, "window binary")
    drawn = F.pmod(F.xxhash64(F.lit(11), "window"), F.lit(1 << 30)) < F.lit(int((1 << 30) * min(1.0, _SAMPLES / max(total, 1))))
    samples = sorted(bytes(r["window"]) for r in parts.where(drawn).collect())
    random.Random(7).shuffle(samples)
    return _trained(samples, _BASE) if samples else b""


def _tops(rows: DataFrame, pairs: list[tuple[bytes, bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Labels, and the largest gain of every text by pair of dictionaries, size of window and discount."""
    shared = rows.sparkSession.sparkContext.broadcast(pairs)

    def run(batches):
        measures = [Distances(*pair) for pair in shared.value]
        for batch in batches:
            tops = []
            for text in batch["text"]:
                top = []
                for measure in measures:
                    for saved, sizes in measure.saved(text):
                        top += [float(np.where(saved > 0, saved - d * sizes, 0).max(initial=0)) for d in _DISCOUNTS]
                tops.append(top)
            yield pd.DataFrame({"toxic": batch["toxic"], "tops": tops})

    found = rows.select("text", "toxic").mapInPandas(run, "toxic int, tops array<double>").toPandas()
    tops = np.array(found["tops"].map(list).tolist(), float).reshape(-1, len(pairs), 2, len(_DISCOUNTS))
    return found["toxic"].to_numpy(int), tops


def _calibrated(toxic: np.ndarray, tops: np.ndarray) -> tuple[float, tuple[float, ...]]:
    """Error and thresholds of one pair and discount, ``tops`` being (texts, sizes of window).

    A size after the other gets the threshold with the fewest errors of all sizes up to it, a false
    alarm counting as three misses; of a run of thresholds that do equally well the middle one.
    """
    caught, error, out = np.zeros(len(toxic), bool), 0.0, []
    for size in range(tops.shape[1]):
        called = caught[:, None] | (tops[:, size, None] >= _STEPS)
        wrong = (~called[toxic == 1]).mean(axis=0) + _ALARM * called[toxic == 0].mean(axis=0)
        first = int(wrong.argmin())
        run = first + int(np.argmin(np.append(wrong[first:] <= wrong[first] + 1e-9, False)))
        out.append(float(_STEPS[(first + run) // 2 if run < len(_STEPS) else (first + len(_STEPS) - 1) // 2]))
        caught |= tops[:, size] >= out[-1]
        error = float(wrong[first])
    return error, tuple(out)


def fit(rows: DataFrame) -> Model | None:
    """Train a dictionary on each kind of text; choose size, discount and thresholds on other texts.

    ``rows`` has ``text`` and ``toxic`` (0 or 1). Two thirds of the texts, by a hash of the text,
    train. Zstandard makes the ordinary dictionary from windows of ordinary texts and the
    toxic one from the windows of one and two words that have far more different neighbourhoods
    in toxic texts than in ordinary ones. The last third decides: of the numbers of windows and the
    discounts those with the fewest errors win, with a threshold for each size of window. Texts
    are read whole on the executors; the driver gets windows and one row of gains per checked
    text. None without texts of both kinds in both parts, or if no window marks the toxic ones.
    """
    last = F.pmod(F.xxhash64(F.lit(5), "text"), F.lit(3)) == 0
    train, check = rows.where(~last), rows.where(last)
    parts = {(r["toxic"], r["last"]) for r in rows.select("toxic", last.alias("last")).distinct().collect()}
    if len(parts) < 4:
        return None
    marked = _marked(train, max(_CHOICES))
    if not marked:
        return None
    ordinary = _ordinary_dictionary(train)
    sizes = [n for k, n in enumerate(_CHOICES) if not k or _CHOICES[k - 1] < len(marked)]
    pairs = [(ordinary, _toxic_dictionary(marked[-n:])) for n in sizes]
    toxic, tops = _tops(check, pairs)
    best = None
    for k, pair in enumerate(pairs):
        for d, discount in enumerate(_DISCOUNTS):
            error, thresholds = _calibrated(toxic, tops[:, k, :, d])
            if best is None or error < best[0]:
                best = error, Model(*pair, thresholds, discount)
    return best[1]


def score(gains: list[np.ndarray], thresholds: tuple[float, ...]) -> tuple[float, int, float]:
    """Score from 0 to 1, windows at their threshold, and the largest gain over a threshold.

    One half lies just below the threshold of the size that comes nearest; further hits add a little.
    """
    margin = max(float(g.max(initial=0)) - t for g, t in zip(gains, thresholds))
    hits = sum(int((g >= t).sum()) for g, t in zip(gains, thresholds))
    return 1 / (1 + math.exp(-(margin + 0.1) - 0.5 * math.log1p(hits))), hits, margin


def labelled_rows(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    toxic_rows: int = TOXIC_ROWS, ordinary_rows: int = ORDINARY_ROWS,
) -> DataFrame:
    """``(text, toxic)`` of at most the given number of labelled rows, the first in the order of a hash of the id.

    Texts are whole. Ids that repeat have one row, of the least text; an id with both labels is
    toxic. Rows without an id, a label of 0 or 1 or any text are left out.
    """
    known = labels.where(F.col("toxic").isin(0, 1) & F.col(id_col).isNotNull()).groupBy(id_col).agg(F.max("toxic").cast("int").alias("toxic"))
    known = checkpoint(known.withColumn("h", F.xxhash64(F.col(id_col).cast("string"))))
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    chosen = []
    for toxic, n in ((1, toxic_rows), (0, ordinary_rows)):
        # A share of all hashes that holds n rows but for a chance of one in a thousand million.
        share = min(1.0, (n + 6 * math.sqrt(n) + 36) / max(counts.get(toxic, 0), 1))
        below = known.where((F.col("toxic") == toxic) & (F.col("h") <= F.lit(int(2**63 * (2 * share - 1)) if share < 1 else 2**63 - 1)))
        chosen.append(below.orderBy("h", id_col).limit(n).select(id_col, "toxic"))
    # At most toxic_rows + ordinary_rows ids.
    few = F.broadcast(chosen[0].union(chosen[1]))
    rows = docs.select(id_col, F.col(text_col).cast("string").alias("text")).join(few, id_col).where("trim(text) != ''")
    return checkpoint(rows.groupBy(id_col, "toxic").agg(F.min("text").alias("text")).select("text", "toxic"))


def score_documents(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, score, predicted, n_hits, margin)`` per row, by the whole text.

    ``margin`` is the largest gain less the threshold of its size of window. A null, empty or
    wordless text has no window and gains nothing; without a model, for want of labels of both
    kinds, every score and margin is 0. Each row is scored by itself, repeated ones alike; ids may
    be null, other columns are not read, an empty table gives an empty result.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        measure = Distances(model.ordinary, model.toxic) if model else None
        for batch in batches:
            found = [score(measure.gains(t, model.discount), model.thresholds) if model else (0.0, 0, 0.0) for t in batch["text"]]
            out = pd.DataFrame(found, columns=["score", "n_hits", "margin"])
            yield out.assign(id=plain(batch["id"]))

    chosen = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"))
    made = chosen.mapInPandas(run, "id string, score double, n_hits bigint, margin double")
    return made.select(F.col("id").cast(id_type).alias(id_col), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_hits", "margin")


def classify(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    toxic_rows: int = TOXIC_ROWS, ordinary_rows: int = ORDINARY_ROWS,
) -> DataFrame:
    """Fit on the labelled rows given, at most so many of either label, and score all of ``docs``."""
    return score_documents(docs, fit(labelled_rows(docs, labels, id_col, text_col, toxic_rows, ordinary_rows)), id_col, text_col)
