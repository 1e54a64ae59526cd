"""Isolation forest: distributed sampling and building, broadcast scoring.

The trees are invariant to shifting and scaling a feature, so features stay as they are.
"""

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forecourt import schema as S
from forecourt import vocabulary as V
from forecourt.functions.numeric import known, percent, round_half_even
from forecourt.operators.distribution import bottom_k
from forecourt.operators.quantiles import quantiles
from forecourt.session import checkpoint, discard, stored

FEATURES = list(V.SEGMENT_FEATURES)
_EULER = 0.5772156649015329
_LEAF = -1

# Forest size and share of anomalies.
TREES = 200
SAMPLE = 256
CONTAMINATION = 0.05


def expected_path(n: int) -> float:
    """Mean depth at which a search among ``n`` random points ends without a hit."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1) + _EULER) - 2.0 * (n - 1) / n


def _complete(features: Sequence[str]) -> Column:
    test = F.lit(True)
    for c in features:
        test = test & known(F.col(c)).isNotNull()
    return test


def _draw(seed: int, *parts: Column) -> Column:
    """A number in (0, 1) fixed by seed and values, the same in any engine that knows md5."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[p.cast("string") for p in parts]))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / float(2**32)


def tree_samples(df: DataFrame, n_rows: int, features: Sequence[str], trees: int, sample: int,
                 seed: int, key: str) -> DataFrame:
    """``sample`` random rows per tree, chosen by hash and so independent of partitioning.

    Every complete row may enter every tree, each with the same small chance, which leaves
    about two samples per tree to rank. A row's first hash gives the gap before the first tree it
    joins, which for nearly all rows of a large table lies beyond the last; further hashes
    are made for the trees it does join. So a row costs one hash and about ``2 * sample * trees`` pairs
    are made whatever the number of rows.
    """
    share = min(1.0, 2.0 * sample / max(n_rows, 1))
    rows = df.where(_complete(features)).select(
        F.col(key).alias("_key"), *[F.col(c).cast("double").alias(c) for c in features]
    )

    def gap(j: Column) -> Column:
        if share >= 1:
            return F.lit(0).cast("bigint")
        return F.floor(F.ln(_draw(seed + 1, j, F.col("_key"))) / F.lit(math.log1p(-share)))

    def step(joined: Column, j: Column) -> Column:
        last = F.element_at(joined, -1)
        return F.when(last < trees, F.concat(joined, F.array(last + 1 + gap(j)))).otherwise(joined)

    first = rows.withColumn("_first", gap(F.lit(0))).where(F.col("_first") < trees)
    joined = F.aggregate(F.sequence(F.lit(1), F.lit(trees)), F.array("_first"), step)
    drawn = first.withColumn("tree", F.explode(F.filter(joined, lambda t: t < trees)).alias("tree")).drop("_first")
    drawn = drawn.withColumn("tree", F.col("tree").cast("int"))
    drawn = drawn.withColumn("_draw", _draw(seed + 2, F.col("tree"), F.col("_key")))
    order = Window.partitionBy("tree").orderBy("_draw", "_key")
    return drawn.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= sample)


def _builder(features: Sequence[str], sample: int, seed: int):
    features = list(features)

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        """Split one tree's sample at random until points are alone or the depth is used up."""
        tree = int(rows["tree"].iloc[0])
        points = rows.sort_values("_rank")[features].to_numpy(float)
        rng = np.random.default_rng([seed, tree])
        limit = math.ceil(math.log2(max(len(points), 2)))
        nodes: list[list] = []
        todo = [(np.arange(len(points)), 0, None, None)]
        while todo:
            members, depth, parent, side = todo.pop()
            node = len(nodes)
            if parent is not None:
                nodes[parent][side] = node
            part = points[members]
            low, high = part.min(axis=0), part.max(axis=0)
            splittable = np.flatnonzero(high > low)
            if depth >= limit or len(members) <= 1 or not len(splittable):
                nodes.append([tree, node, _LEAF, 0.0, node, node, depth + expected_path(len(members))])
                continue
            feature = int(rng.choice(splittable))
            cut = float(rng.uniform(low[feature], high[feature]))
            nodes.append([tree, node, feature, cut, node, node, 0.0])
            left = part[:, feature] <= cut
            todo.append((members[~left], depth + 1, node, 5))
            todo.append((members[left], depth + 1, node, 4))
        return pd.DataFrame(nodes, columns=S.ISOLATION_NODES.names)

    return build


@dataclass
class IsolationForest:
    """Fitted trees with the score offset below which a row counts as an anomaly."""

    nodes: DataFrame
    features: list[str]
    sample: int
    offset: float | None = None


def fit_isolation_forest(df: DataFrame, trees: int = TREES, sample: int = SAMPLE,
                         contamination: float | None = CONTAMINATION, seed: int = 42,
                         features: Sequence[str] = FEATURES, key: str = "listing_id") -> IsolationForest:
    """Build the trees in parallel, each from its own sample, and set the offset.

    The node table holds at most ``trees * (2 * sample - 1)`` rows. The offset is the exact
    ``contamination`` quantile of the rows' raw scores, which are stored once for it.
    """
    complete = df.where(_complete(features))
    n_rows = complete.count()
    sample = min(sample, n_rows)
    nodes = checkpoint(
        tree_samples(df, n_rows, features, trees, sample, seed, key)
        .groupBy("tree")
        .applyInPandas(_builder(features, sample, seed), S.ISOLATION_NODES)
    )
    forest = IsolationForest(nodes, list(features), sample)
    if contamination is not None:
        scores = stored(raw_scores(complete, forest).select("raw_score"), "raw-scores")
        forest.offset = quantiles(scores, "raw_score", {"q": contamination}).first()[0]
        discard(scores)
    return forest


def _packed(nodes: DataFrame) -> dict[str, np.ndarray]:
    """The bounded node table as arrays over all trees, children as global positions."""
    table = nodes.toPandas().sort_values(["tree", "node"], ignore_index=True)
    sizes = table.groupby("tree", sort=True).size().to_numpy()
    roots = np.cumsum(sizes) - sizes
    base = np.repeat(roots, sizes)
    leaf = table["feature"].to_numpy() == _LEAF
    return {
        "roots": roots.astype(np.int64),
        "feature": np.where(leaf, 0, table["feature"].to_numpy()).astype(np.int64),
        # A leaf sends every value to itself.
        "threshold": table["threshold"].to_numpy(float),
        "left": (table["left"].to_numpy() + base).astype(np.int64),
        "right": (table["right"].to_numpy() + base).astype(np.int64),
        "path": table["path"].to_numpy(float),
    }


def raw_scores(df: DataFrame, forest: IsolationForest) -> DataFrame:
    """Adds ``raw_score``: -2^(-mean path / expected path), near -1 for isolated rows.

    A row that lacks a feature has no score.
    """
    packed = df.sparkSession.sparkContext.broadcast(_packed(forest.nodes))
    depth = math.ceil(math.log2(max(forest.sample, 2)))
    norm = expected_path(forest.sample) or 1.0

    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        t = packed.value
        for columns in batches:
            parts = columns if isinstance(columns, tuple) else (columns,)  # one feature comes bare
            x = np.column_stack([c.to_numpy(float) for c in parts])
            every = np.arange(len(x))
            total = np.zeros(len(x))
            for root in t["roots"]:
                at = np.full(len(x), root)
                for _ in range(depth):
                    goes_left = x[every, t["feature"][at]] <= t["threshold"][at]
                    at = np.where(goes_left, t["left"][at], t["right"][at])
                total += t["path"][at]
            yield pd.Series(-np.exp2(-total / len(t["roots"]) / norm))

    inputs = [F.col(c).cast("double") for c in forest.features]
    return df.withColumn("raw_score", F.when(_complete(forest.features), score(*inputs)))


def score_isolation_forest(df: DataFrame, forest: IsolationForest) -> DataFrame:
    """Adds ``anomaly_score`` (negative for anomalies) and ``is_anomaly``."""
    offset = forest.offset if forest.offset is not None else -0.5
    return (
        raw_scores(df, forest)
        .withColumn("anomaly_score", F.col("raw_score") - F.lit(offset))
        .withColumn("is_anomaly", F.col("anomaly_score") < 0)
        .drop("raw_score")
    )


def anomaly_table(scored: DataFrame) -> DataFrame:
    """The stored form: a listing's main columns with its score."""
    return scored.select(*S.ANOMALIES.names)


def anomaly_summary(scored: DataFrame) -> DataFrame:
    hits = F.count_if("is_anomaly")
    rows = F.count(F.lit(1))
    return scored.agg(
        hits.alias("n_anomalies"), (rows - hits).alias("n_normal"),
        round_half_even(percent(hits, rows), 1).alias("pct_anomalies"),
    )


def top_anomalies(scored: DataFrame, k: int = 20, key: str = "listing_id") -> DataFrame:
    """The ``k`` anomalies with the lowest score, rounded to 4 digits."""
    best = bottom_k(scored.where("is_anomaly"), "anomaly_score", k, key)
    return best.withColumn("anomaly_score", round_half_even(F.col("anomaly_score"), 4))
