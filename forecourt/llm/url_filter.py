"""URL verdicts: host and path rules first, then gradient-boosted trees on lexical features."""

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Most labelled URLs that a model is fitted on.
SAMPLE = 20_000
_FOLDS = 5
_URL = re.compile(r"(.*?)://([^/?#]*)([^?#]*)(\??[^#]*)(#?.*)", re.S)
FEATURES = (
    "length", "host_length", "path_length", "depth", "labels", "digit_ratio", "host_digits", "host_hyphens", "path_hyphens",
    "entropy", "host_entropy", "vowel_ratio", "parameters", "query_length", "has_fragment", "has_extension",
    "suffix_rate", "suffix_seen", "suffix2_rate", "suffix2_seen",
)


def host_of(url: str = "url") -> F.Column:
    """From behind the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased; empty without one."""
    host = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: str = "url") -> F.Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def matching_rule(rules: dict[str, str], host: str = "host", path: str = "path") -> F.Column:
    """The longest rule that fits, as ``host/path``: its host or a subdomain, and a path that starts with its own."""
    whens = []
    for rule in sorted(rules, key=lambda r: (-len(r), r)):
        name, _, rest = rule.partition("/")
        fits = ((F.col(host) == name) | F.endswith(F.col(host), F.lit("." + name))) & F.startswith(F.col(path), F.lit("/" + rest))
        whens.append(F.when(fits, F.lit(rule)))
    return F.coalesce(*whens, F.lit(None).cast("string"))


def _entropy(text: str) -> float:
    if not text:
        return 0.0
    counts = np.unique(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32), return_counts=True)[1] / len(text)
    return float(-(counts * np.log2(counts)).sum())


def _suffixes(host: str) -> tuple[str, str]:
    parts = host.split(".")
    return parts[-1], ".".join(parts[-2:])


def lexical(url: str | None, suffixes: dict[str, tuple[float, int]], prior: float) -> list[float]:
    """``FEATURES`` of a URL; ``suffixes`` has the rate of blocked labelled URLs and their number."""
    text = url or ""
    _, host, path, query, fragment = (m.groups() if (m := _URL.fullmatch(text)) else ("", "", "", "", ""))
    host = host.lower()
    letters = sum(c.isalpha() for c in host) or 1
    rates = [x for s in _suffixes(host) for x in suffixes.get(s, (prior, 0))]
    return [
        len(text), len(host), len(path), path.count("/"), host.count(".") + 1, sum(c.isdigit() for c in text) / max(1, len(text)),
        sum(c.isdigit() for c in host), host.count("-"), path.count("-"), _entropy(text), _entropy(host),
        sum(c in "aeiou" for c in host) / letters, query.count("=") , len(query), float(bool(fragment)),
        float("." in path.rpartition("/")[2]), *rates,
    ]


def _suffix_rates(urls: list[str], labels: np.ndarray, prior: float) -> dict[str, tuple[float, int]]:
    seen: dict[str, list[int]] = {}
    for url, label in zip(urls, labels):
        host = m.group(2).lower() if (m := _URL.fullmatch(url or "")) else ""
        for s in _suffixes(host):
            pair = seen.setdefault(s, [0, 0])
            pair[0] += int(label)
            pair[1] += 1
    return {s: ((bad + 10 * prior) / (n + 10), n) for s, (bad, n) in seen.items()}


@dataclass(frozen=True)
class Model:
    """Trees as arrays (feature, threshold, left, right, value), the prior log-odds and the suffixes."""

    trees: tuple
    start: float
    suffixes: dict
    prior: float

    def probability(self, urls: list[str | None]) -> np.ndarray:
        x = np.array([lexical(u, self.suffixes, self.prior) for u in urls], float).reshape(len(urls), len(FEATURES))
        total = np.full(len(urls), self.start)
        for feature, threshold, left, right, value in self.trees:
            node = np.zeros(len(urls), np.int64)
            while (inner := feature[node] >= 0).any():
                down = np.where(x[np.arange(len(urls)), np.maximum(feature[node], 0)] <= threshold[node], left[node], right[node])
                node = np.where(inner, down, node)
            total += value[node]
        return 1 / (1 + np.exp(-total))


def _tree(x: np.ndarray, cuts: list[np.ndarray], g: np.ndarray, h: np.ndarray, depth: int, rate: float, least: int) -> tuple:
    """One regression tree on gradients, grown by the gain of the best cut of each node."""
    nodes: list[list] = []

    def grow(rows: np.ndarray, left: int) -> int:
        me = len(nodes)
        total_g, total_h = g[rows].sum(), h[rows].sum()
        nodes.append([-1, 0.0, 0, 0, rate * total_g / (total_h + 1)])
        best = (1e-6, 0, 0.0)
        for f in range(x.shape[1]) if left else ():
            bins = np.searchsorted(cuts[f], x[rows, f], "left")
            size = len(cuts[f]) + 1
            gs, hs, ns = (np.bincount(bins, w, size).cumsum()[:-1] for w in (g[rows], h[rows], None))
            gain = gs**2 / (hs + 1) + (total_g - gs) ** 2 / (total_h - hs + 1) - total_g**2 / (total_h + 1)
            gain[(ns < least) | (len(rows) - ns < least)] = 0
            if len(gain) and gain.max() > best[0]:
                best = (gain.max(), f, cuts[f][gain.argmax()])
        if best[0] > 1e-6:
            go = x[rows, best[1]] <= best[2]
            nodes[me][:2] = best[1], best[2]
            nodes[me][2] = grow(rows[go], left - 1)
            nodes[me][3] = grow(rows[~go], left - 1)
        return me

    grow(np.arange(len(x)), depth)
    columns = list(zip(*nodes))
    return tuple(np.array(c) for c in columns)


def fit(urls: list[str], blocked: list[int], trees: int = 60, depth: int = 3, rate: float = 0.2, least: int = 5) -> Model | None:
    """Logistic boosting on the labelled URLs; None without labels of both kinds.

    A URL's suffix rates are taken from the other folds while fitting, so that its own label
    doesn't tell.
    """
    y = np.array(blocked, float)
    if not len(y) or y.min() == y.max():
        return None
    prior = float(y.mean())
    fold = np.arange(len(y)) % _FOLDS
    x = np.zeros((len(y), len(FEATURES)))
    for k in range(_FOLDS):
        mine = np.flatnonzero(fold == k)
        others = np.flatnonzero(fold != k)
        rates = _suffix_rates([urls[i] for i in others], y[others], prior)
        for i in mine:
            x[i] = lexical(urls[i], rates, prior)
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, 65)[1:-1], method="nearest")) for c in x.T]
    cuts = [c[c < column.max()] for c, column in zip(cuts, x.T)]
    start = float(np.log(prior / (1 - prior)))
    total, grown = np.full(len(y), start), []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        tree = _tree(x, cuts, y - p, p * (1 - p), depth, rate, least)
        grown.append(tree)
        feature, threshold, left, right, value = tree
        node = np.zeros(len(y), np.int64)
        while (inner := feature[node] >= 0).any():
            down = np.where(x[np.arange(len(y)), np.maximum(feature[node], 0)] <= threshold[node], left[node], right[node])
            node = np.where(inner, down, node)
        total += value[node]
    return Model(tuple(grown), start, _suffix_rates(urls, y, prior), prior)


def train(labelled: DataFrame, url_col: str = "url", label_col: str = "blocked", sample: int = SAMPLE) -> Model | None:
    """Fit on at most ``sample`` of the labelled rows, those with the least hashes of their URLs."""
    known = labelled.where(F.col(url_col).isNotNull() & F.col(label_col).isin(0, 1)).groupBy(F.col(url_col).alias("u")).agg(F.max(label_col).alias("y"))
    rows = known.orderBy(F.xxhash64("u"), "u").limit(sample).collect()
    return fit([r["u"] for r in rows], [r["y"] for r in rows])


def judge(pages: DataFrame, rules: dict[str, str], model: Model | None, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``(id, host, path, rule, score, verdict)`` per row: the rule's verdict, else block from a score of 0.5 on.

    A null URL, or one without ``://``, has an empty host and path, fits no rule and is scored as it
    stands. Without a model the score is 0 and what no rule blocks is allowed.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def probability(urls: pd.Series) -> pd.Series:
        model = shared.value
        known = urls.astype(object).where(urls.notna(), None).tolist()
        return pd.Series(model.probability(known) if model and len(known) else np.zeros(len(known)))

    parts = pages.select(F.col(id_col), F.col(url_col).alias("__url"), host_of(url_col).alias("host"), path_of(url_col).alias("path"))
    ruled = parts.withColumn("rule", matching_rule(rules)).withColumn("score", probability("__url"))
    by_rule = F.element_at(F.create_map(*[F.lit(x) for pair in rules.items() for x in pair]), F.col("rule")) if rules else F.lit(None).cast("string")
    verdict = F.when(F.col("rule").isNotNull(), by_rule).when(F.col("score") >= 0.5, "block").otherwise("allow")
    return ruled.withColumn("verdict", verdict).drop("__url")
