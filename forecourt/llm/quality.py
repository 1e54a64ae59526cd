"""Quality rules: a decision list learned from labelled statistics, run as Spark conditions."""

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.llm.common import plain, stored, text_key

#: Most labelled rows that a list is learned from.
SAMPLE = 20_000
_SYMBOLS = b"#*$%&|<>"
_CAPITALS = bytes(range(65, 91))
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_digits", "n_marks")
#: What the rules may test, from the statistics. Ratios are those of a document with a word.
FEATURES = {
    "n_words": "n_words",
    "chars_per_word": "try_divide(word_chars, n_words)",
    "symbols_per_word": "try_divide(n_symbols, n_words)",
    "dup_line_share": "try_divide(n_dup_lines, n_lines)",
    "repeat_share": "try_divide(n_repeat_words, n_words)",
    "capital_share": "try_divide(n_capitals, word_chars)",
    "digit_share": "try_divide(n_digits, word_chars)",
    "marks_per_word": "try_divide(n_marks, n_words)",
}


def _count(raw: bytes, of: bytes) -> int:
    return len(raw) - len(raw.translate(None, of))


def statistics(text: str | None) -> tuple[int, ...]:
    """``STATISTICS`` of a whole text; a null one has no word.

    Repeated windows are found by a 64-bit hash of their words.
    """
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    if not words:
        return (0, 0, _count(raw, _SYMBOLS), 0, 0, 0, 0, 0, 0)
    joined = b"".join(words)
    letters = np.frombuffer(joined, np.uint8)
    chars = int(((letters & 0xC0) != 0x80).sum())
    lines = [x for x in raw.split(b"\n") if x.strip()]
    repeated = 0
    if len(words) >= 6:
        codes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
        window = np.zeros(len(words) - 4, np.uint64)
        for k in range(5):
            window = window * np.uint64(0x9E3779B97F4A7C15) + codes[k : len(words) - 4 + k]
            window ^= window >> np.uint64(29)
        order = np.argsort(window, kind="stable")
        same = window[order][1:] == window[order][:-1]
        if same.any():
            twice = np.zeros(len(window), bool)
            twice[order[1:][same]] = twice[order[:-1][same]] = True
            cover = np.zeros(len(words) + 1, np.int64)
            at = np.flatnonzero(twice)
            cover[at] += 1
            cover[at + 5] -= 1
            repeated = int((cover.cumsum()[:-1] > 0).sum())
    marks = _count(raw, b"!?;:.,")
    return (
        len(words), chars, _count(raw, _SYMBOLS), len(lines) - len(set(lines)), repeated, len(lines),
        _count(joined, _CAPITALS), _count(joined, b"0123456789"), marks,
    )


def with_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, key, *STATISTICS)`` per row; ``key`` is a hash of the text."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            out = pd.DataFrame([statistics(t) for t in batch["text"]], columns=list(STATISTICS))
            yield out.assign(id=plain(batch["id"]), key=batch["key"].to_numpy())

    chosen = docs.select(F.col(id_col).cast("string").alias("id"), text_key(text_col).alias("key"), F.col(text_col).cast("string").alias("text"))
    made = chosen.mapInPandas(run, "id string, key bigint, " + ", ".join(f"{c} bigint" for c in STATISTICS))
    return made.select(F.col("id").cast(id_type).alias(id_col), "key", *STATISTICS)


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, rows: pd.DataFrame) -> np.ndarray:
        values = rows[self.feature].to_numpy()
        return values > self.threshold if self.above else values <= self.threshold

    def sql(self) -> str:
        return f"({FEATURES[self.feature]}) {'>' if self.above else '<='} {self.threshold!r}D"


Rule = tuple[Condition, ...]


def _covered(rule: Rule, rows: pd.DataFrame) -> np.ndarray:
    out = np.ones(len(rows), bool)
    for condition in rule:
        out &= condition.holds(rows)
    return out


def _grow(rows: pd.DataFrame, bad: np.ndarray, candidates: dict[str, np.ndarray]) -> Rule:
    """Add the condition with the greatest information gain until the rule covers no good row."""
    rule, inside = (), np.ones(len(rows), bool)
    while (inside & ~bad).any():
        p, n = (inside & bad).sum(), (inside & ~bad).sum()
        best = None
        for feature, cuts in candidates.items():
            values = rows[feature].to_numpy()[inside]
            order = np.argsort(values, kind="stable")
            labels = np.concatenate(([0], np.cumsum(bad[inside][order])))
            at = np.searchsorted(values[order], cuts, "right")
            for above in (False, True):
                pos = labels[-1] - labels[at] if above else labels[at]
                size = len(values) - at if above else at
                neg = size - pos
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(pos > 0, pos * (np.log2(pos / np.maximum(size, 1)) - np.log2(p / (p + n))), -np.inf)
                k = int(np.argmax(gain))
                if gain[k] > 1e-9 and neg[k] < n and (best is None or gain[k] > best[0]):
                    best = (gain[k], Condition(feature, above, float(cuts[k])))
        if best is None:
            break
        rule += (best[1],)
        inside &= best[1].holds(rows)
    return rule


def _prune(rule: Rule, rows: pd.DataFrame, bad: np.ndarray) -> tuple[Rule, float, int]:
    """The beginning of the rule that is best on rows it was not grown on, its precision and its cover."""
    best = (-2.0, rule, 0.0, 0)
    for length in range(len(rule), 0, -1):
        inside = _covered(rule[:length], rows)
        p, n = int((inside & bad).sum()), int((inside & ~bad).sum())
        worth = (p - n) / (p + n) if p + n else -1.0
        if worth > best[0]:
            best = (worth, rule[:length], p / (p + n) if p + n else 0.0, p)
    return best[1], best[2], best[3]


def learn(rows: pd.DataFrame, min_precision: float = 0.97, min_cover: int = 3) -> list[Rule]:
    """Sequential covering: rules for rejection, in the order in which they were found.

    ``rows`` has the features and ``bad``. A rule is grown on two thirds of what the rules so far
    leave and pruned on the rest; the list ends with the first rule that, on the latter, is less
    precise than ``min_precision`` or covers fewer bad rows than ``min_cover``.
    """
    rules: list[Rule] = []
    rows = rows.reset_index(drop=True)
    features = [c for c in rows.columns if c != "bad"]
    while len(rows) and rows["bad"].any():
        grow = np.arange(len(rows)) % 3 < 2
        candidates = {}
        for f in features:
            values = np.unique(np.quantile(rows[f], np.linspace(0, 1, 129), method="nearest"))
            if len(values) > 1:
                candidates[f] = (values[1:] + values[:-1]) / 2
        bad = rows["bad"].to_numpy(bool)
        rule = _grow(rows[grow], bad[grow], candidates)
        rule, precision, cover = _prune(rule, rows[~grow], bad[~grow])
        if not rule or precision < min_precision or cover < min_cover:
            break
        rules.append(rule)
        rows = rows[~_covered(rule, rows)].reset_index(drop=True)
    return rules


def expression(rules: list[Rule], value: str = "false", otherwise: str = "true") -> str:
    """The list as one ordered conditional expression of Spark SQL."""
    whens = "".join(f" WHEN {' AND '.join(c.sql() for c in rule)} THEN {value}" for rule in rules)
    return f"CASE{whens} ELSE {otherwise} END" if rules else otherwise


def base_failed(min_words: int = 10, max_repeat_percent: int = 20) -> F.Column:
    return (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))


def fit(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", sample: int = SAMPLE) -> list[Rule]:
    """Learn from at most ``sample`` labelled rows, those with the least hashes of their ids.

    Rows that fail the base rules are left out, as no learned rule will see them.
    """
    known = labels.where(F.col("quality").isin(0, 1) & F.col(id_col).isNotNull()).groupBy(id_col).agg(F.min("quality").alias("__q"))
    order = F.xxhash64(F.col(id_col).cast("string"))
    wanted = known.orderBy(order, id_col).limit(sample)
    features = [F.expr(e).cast("double").alias(name) for name, e in FEATURES.items()]
    rows = stats.where(~base_failed()).join(F.broadcast(wanted), id_col)
    # One text for each id, that of the least hash, so that repeated ids can't exceed the bound.
    rows = rows.groupBy(id_col, "__q").agg(F.min(F.struct("key", *features)).alias("f"))
    rows = rows.select(order.alias("__o"), id_col, *[f"f.{c}" for c in FEATURES], (F.col("__q") == 0).alias("bad")).toPandas()
    return learn(rows.sort_values(["__o", id_col]).drop(columns=["__o", id_col]))


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, key, *STATISTICS, base_failed, rule, kept)`` per row.

    ``kept`` is false for what fails the base rules and for what a learned rule rejects; ``rule``
    is the number of that rule. A null or empty text fails. Without labels nothing is learned.
    """
    stats = stored(with_statistics(docs, id_col, text_col), "statistics")
    rules = fit(stats, labels, id_col)
    number = "CASE" + "".join(f" WHEN {' AND '.join(c.sql() for c in r)} THEN {k}" for k, r in enumerate(rules)) + " END" if rules else "cast(null as int)"
    marked = stats.withColumn("base_failed", base_failed())
    return marked.withColumn("rule", F.when(~F.col("base_failed"), F.expr(number))).withColumn(
        "kept", F.when(F.col("base_failed"), False).otherwise(F.expr(expression(rules)))
    )


def keep_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept. A row is known by its id and text, so null ids and repeats are safe."""
    verdict = judge(docs, labels, id_col, text_col).where("NOT kept").select(F.col(id_col).alias("__id"), F.col("key").alias("__key")).distinct()
    same = F.col(id_col).eqNullSafe(F.col("__id")) & (text_key(text_col) == F.col("__key"))
    return docs.join(verdict, same, "left_anti")
