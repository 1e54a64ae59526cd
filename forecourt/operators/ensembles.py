"""Forests and boosting whose trees, folds and classes grow side by side, and the fitted model."""

from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Transformer
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.functions.numeric import feature_values
from forecourt.operators import trees as T
from forecourt.session import discard, stored

#: Boosting steps between two writes of the margins; Spark caches those of the steps between, each made from the one before.
STEPS = 10
#: Bytes of trees that are broadcast together; larger models are scored in several passes.
BROADCAST = 128 << 20
#: How often a row is drawn with replacement: the limit of the binomial law, cut where 64 bits end.
_DRAWS = np.cumsum([np.exp(-1.0) / np.prod(np.arange(1.0, k + 1)) for k in range(18)])

_TREES = "variant int, tree int, class int, " + ", ".join(f"{c} binary" for c in ("feature", "cut", "left", "value", "gain"))


@dataclass(frozen=True)
class Ensemble:
    """What to fit: a forest's trees are averaged, a boosting's are added up, ``rate`` times each.

    ``classes`` is 0 for a number. Boosting of classes has a tree for each class in every step, fitted to the
    gradients of joint probabilities. ``row_share`` and ``column_share`` are drawn once per step.
    """

    kind: str
    trees: int
    growth: T.Growth
    label: str
    rate: float = 0.1
    bootstrap: bool = True
    row_share: float = 1.0
    column_share: float = 1.0
    classes: int = 0
    seed: int = 42
    local_rows: int = T.LOCAL_ROWS

    @property
    def outputs(self) -> int:
        return max(1, self.classes)

    def fit(self, df: DataFrame) -> "TreeModel":
        """The model of a table with ``features`` and the label."""
        return fit_ensemble(df, self)[0]


def _salt(seed: int, tree: int) -> int:
    return seed * 1_000_003 + tree + 1


def fit_ensemble(
    df: DataFrame, spec: Ensemble, key: Column | None = None, train: Column | None = None, fold: Column | None = None, folds: int = 0,
) -> tuple["TreeModel", pd.DataFrame]:
    """The model of the rows where ``train``, and R² of it on them and of each fold's own model on its fold.

    All of them grow in the same jobs. Fold i's model learns from every row outside the fold; all use
    the bins and codes of the table at hand. ``key`` (by default a hash of the row) decides what is drawn.
    The scores have ``variant`` (-1: the model itself) and ``r2``; they are empty for classes.
    """
    yes = F.lit(True) if train is None else train
    key = F.xxhash64(feature_values(df), F.col(spec.label)) if key is None else key
    size = len(df.select(feature_values(df)).first()[0])
    layout = T.fit_layout(df.where(yes), size)
    matrix = T.build_matrix(df, layout, spec.label, key, F.lit(-1) if fold is None else fold, yes)
    variants = [-1, *range(folds)]
    grown = _forest(matrix, layout, spec, variants) if spec.kind == "forest" else _boosted(matrix, layout, spec, variants)
    own, base, scores = grown
    discard(matrix)
    return TreeModel(own, layout, spec, base), scores


def _counts(matrix: DataFrame, features: int, spec: Ensemble, variants: Sequence[int]) -> dict[int, np.ndarray]:
    """Per variant: rows, then the label's sum, or the rows of every class."""

    def run(batches):
        total = np.zeros((len(variants), 1 + spec.outputs))
        for block in T.Block.each(batches, features):
            for i, v in enumerate(variants):
                y = block.y[block.seen(v)]
                total[i, 0] += len(y)
                total[i, 1:] += np.bincount(y.astype(int), minlength=spec.classes) if spec.classes else y.sum()
        yield T.arrow_rows([(int(v), *map(float, t)) for v, t in zip(variants, total)], schema)

    names = ["variant", *(f"s{c}" for c in range(1 + spec.outputs))]
    schema = "variant int, " + ", ".join(f"{c} double" for c in names[1:])
    parts = matrix.mapInArrow(run, schema)
    rows = parts.groupBy("variant").agg(*[F.sum(c).alias(c) for c in names[1:]]).collect()
    return {r["variant"]: np.array(r[1:]) for r in rows}


# Forests


def _forest(matrix, layout, spec, variants):
    features = len(layout.edges)
    counts = _counts(matrix, features, spec, variants)
    n_rows = int(max(c[0] for c in counts.values()))
    n_stats = 2 + spec.outputs
    growth = replace(spec.growth, classes=spec.outputs, labelled=bool(spec.classes))
    # Rows of a step's shuffle are bounded too: trees beyond it wait for the next step.
    step = max(1, min(T.at_once(n_rows, n_stats, layout, spec.local_rows), (8 << 30) // (n_rows * (features + 16)) or 1))
    keys = [i * spec.trees + t for t in range(spec.trees) for i in range(len(variants))]
    spread = T.places(matrix.sparkSession, max(8, matrix.sparkSession.sparkContext.defaultParallelism * 8))
    tables, tasks = [], matrix.rdd.getNumPartitions()
    for at in range(0, len(keys), step):
        some = keys[at : at + step]
        parts, tops = T.grow(matrix, _forest_signal(spec, variants, some), some, n_rows, n_stats, layout, growth, spread, spec.seed, None, spec.local_rows, tasks)
        tables.append(_whole_trees(parts, tops, spec.outputs))
    forest = tables[0]
    for table in tables[1:]:
        forest = forest.unionByName(table)
    index = F.floor(F.col("key") / spec.trees).cast("int")
    named = F.element_at(F.array(*[F.lit(v) for v in variants]), index + 1).alias("variant")
    forest = forest.select(named, (F.col("key") % spec.trees).alias("tree"), F.lit(0).alias("class"), *T._ARRAYS)
    own = stored(forest.where("variant = -1"), "trees")
    if spec.classes:
        return own, [0.0] * spec.classes, pd.DataFrame({"variant": [], "r2": []})
    others = stored(forest.where("variant >= 0"), "fold-trees") if len(variants) > 1 else own.where("variant >= 0")
    for table in tables:
        discard(table)
    marked, base = matrix, np.zeros(len(variants))
    for chunk in tree_chunks(own.unionByName(others)):
        trees = [(variants.index(v), tree) for v, _, tree in chunk]
        after = stored(_advanced(marked, features, [(1.0 / spec.trees, trees)], base), "margins")
        if marked is not matrix:
            discard(marked)
        marked = after
    scores = _scores(marked, features, variants)
    if marked is not matrix:
        discard(marked)
    if len(variants) > 1:
        discard(others)
    return own, [0.0], scores


def _forest_signal(spec: Ensemble, variants: Sequence[int], keys: Sequence[int]) -> T.Signal:
    wanted = set(keys)

    def signal(block: T.Block) -> Iterator:
        seen = [np.flatnonzero(block.seen(v)) for v in variants]
        label = block.y.astype(np.int64)
        for t in range(spec.trees):
            mine = [i for i in range(len(variants)) if i * spec.trees + t in wanted]
            if not mine:
                continue
            drawn = np.searchsorted(_DRAWS, T.mixed(block.keys, _salt(spec.seed, t)), "right").astype(float) if spec.bootstrap else np.ones(block.n)
            for i in mine:
                rows = seen[i][drawn[seen[i]] > 0]
                w = drawn[rows]
                yield i * spec.trees + t, rows, [None, w, label[rows] if spec.classes else w * block.y[rows]]

    return signal


def _whole_trees(parts: DataFrame, tops: dict[int, T.Top], outputs: int) -> DataFrame:
    """``(key, arrays)``: every tree in one piece, stored."""
    if all(len(top.feature) == 1 and top.closed for top in tops.values()):
        return stored(parts.drop("node"), "trees")
    rows = [(k, -1, *map(bytearray, top.tree(outputs).packed())) for k, top in tops.items()]
    trunk = parts.sparkSession.createDataFrame(rows, T.PARTS)

    def graft(group: pd.DataFrame) -> pd.DataFrame:
        read = {int(r.node): T.Tree.unpacked(r, outputs) for r in group.itertuples()}
        whole = read.pop(-1).grafted(read)
        return pd.DataFrame([(int(group["key"].iloc[0]), *whole.packed())], columns=["key", *T._ARRAYS])

    schema = T.PARTS.replace("node int, ", "")
    return stored(parts.unionByName(trunk).groupBy("key").applyInPandas(graft, schema), "trees")


# Boosting


def _add(block: T.Block, steps: list, base: np.ndarray) -> np.ndarray:
    """The margins of all rows after some steps' trees; a block without any starts from ``base``."""
    margin = np.repeat(base[:, None], block.n, axis=1) if block.margin is None else block.margin
    for rate, trees in steps:
        for model, tree in trees:
            margin[model] += rate * tree.value[tree.leaves(block.bins), 0]
    return margin


def _advanced(matrix: DataFrame, features: int, steps: list, base: np.ndarray) -> DataFrame:
    def run(batches):
        for batch in batches:
            for i, block in enumerate(T.Block.each([batch], features)):
                margin = _add(block, steps, base).astype("<f8").tobytes()
                kept = batch.select(T._names(T._MATRIX)).slice(i, 1)
                yield pa.RecordBatch.from_arrays([*kept.columns, pa.array([margin], pa.binary())], [*kept.schema.names, "margin"])

    return matrix.mapInArrow(run, T._MATRIX + ", margin binary")


def _scores(matrix: DataFrame, features: int, variants: Sequence[int]) -> pd.DataFrame:
    """R² of every variant's margins: the model's on the train rows, a fold's on the rows left out."""

    def run(batches):
        out = []
        for block in T.Block.each(batches, features):
            for i, v in enumerate(variants):
                on = block.train if v < 0 else block.fold == v
                y, e = block.y[on], block.y[on] - block.margin[i][on]
                out.append((v, float(on.sum()), float(y.sum()), float((y * y).sum()), float((e * e).sum())))
        yield T.arrow_rows(out, schema)

    schema = "variant int, n double, y double, yy double, ee double"
    rows = matrix.mapInArrow(run, schema)
    total = F.sum("yy") - F.sum("y") * F.sum("y") / F.sum("n")
    return rows.groupBy("variant").agg((1 - F.try_divide(F.sum("ee"), total)).alias("r2")).orderBy("variant").toPandas()


def _boosted(matrix, layout, spec, variants):
    features, k = len(layout.edges), spec.outputs
    counts = _counts(matrix, features, spec, variants)
    n_rows = int(max(c[0] for c in counts.values()))
    with np.errstate(divide="ignore"):
        means = [c[1:] / max(c[0], 1.0) for c in (counts[v] for v in variants)]
        base = np.concatenate([np.log(np.maximum(m, 1e-300)) if spec.classes else m for m in means])
    growth = replace(spec.growth, own_curvature=bool(spec.classes), scale=(k - 1) / k if spec.classes else 1.0)
    n_stats = 4 if spec.classes else 3
    spark = matrix.sparkSession
    keys = list(range(len(variants) * k))
    spread = T.places(spark, len(keys) if n_rows <= spec.local_rows else max(len(keys), spark.sparkContext.defaultParallelism))
    current, own = matrix, []  # the margins begin as one number per model, which needs no table
    written, cached, tasks = matrix, [], matrix.rdd.getNumPartitions()
    for t in range(spec.trees):
        rng = np.random.default_rng([spec.seed, t])
        chosen = np.ones(features, bool)
        if spec.column_share < 1:
            chosen[rng.permutation(features)[max(1, int(spec.column_share * features)) :]] = False
        signal = _boosting_signal(spec, variants, t, base)
        parts, tops = T.grow(current, signal, keys, n_rows, n_stats, layout, growth, spread, spec.seed + t, dict.fromkeys(keys, chosen), spec.local_rows, tasks)
        pieces: dict[int, dict[int, T.Tree]] = {key: {} for key in keys}
        for row in parts.collect():
            pieces[row["key"]][row["node"]] = T.Tree.unpacked(row, 1)
        grown = [(key, tops[key].tree(1).grafted(pieces[key])) for key in keys]
        own += [(-1, t, key, *map(bytearray, tree.packed())) for key, tree in grown if key < k]
        after = _advanced(current, features, [(spec.rate, grown)], base)
        for stale in cached[:-1]:  # the margins made from it are whole by now
            stale.unpersist()
        cached = cached[-1:]
        if t == spec.trees - 1:
            current = after
        elif (t + 1) % STEPS:
            current = after.persist()
            cached.append(current)
        else:
            current = stored(after, "margins")
            for stale in cached:
                stale.unpersist()
            if written is not matrix:
                discard(written)
            written, cached = current, []
    scores = pd.DataFrame({"variant": [], "r2": []}) if spec.classes else _scores(current, features, variants)
    for stale in cached:
        stale.unpersist()
    if written is not matrix:
        discard(written)
    trees = stored(spark.createDataFrame(own, _TREES).repartition(8, "tree"), "trees")
    return trees, base[:k].tolist(), scores


def _boosting_signal(spec: Ensemble, variants: Sequence[int], t: int, base: np.ndarray) -> T.Signal:
    k = spec.outputs

    def signal(block: T.Block) -> Iterator:
        margin = _add(block, [], base)
        drawn = T.mixed(block.keys, _salt(spec.seed, t)) < spec.row_share if spec.row_share < 1 else np.ones(block.n, bool)
        for i, v in enumerate(variants):
            rows = np.flatnonzero(block.seen(v) & drawn)
            mine = margin[i * k : (i + 1) * k, rows]
            if not spec.classes:
                yield i, rows, [None, None, block.y[rows] - mine[0]]
                continue
            p = np.exp(mine - mine.max(axis=0))
            p /= p.sum(axis=0)
            for c in range(k):
                r = (block.y[rows] == c) - p[c]
                yield i * k + c, rows, [None, None, r, np.abs(r) * (1 - np.abs(r))]

    return signal


# The fitted model


def tree_chunks(trees: DataFrame, limit: int = BROADCAST) -> Iterator[list[tuple[int, int, T.Tree]]]:
    """``(variant, class, tree)`` of all trees, at most about ``limit`` bytes at a time; a tree is never cut."""
    outputs = F.octet_length("value") / F.octet_length("gain")
    sizes = trees.select("variant", "tree", "class", (F.octet_length("feature") * 12).alias("bytes"), outputs.cast("int").alias("outputs")).collect()
    groups, held = [[]], 0
    for r in sorted(sizes):
        if groups[-1] and held + r["bytes"] > limit:
            groups.append([])
            held = 0
        groups[-1].append(r)
        held += r["bytes"]
    for group in filter(None, groups):
        first, last = group[0][:3], group[-1][:3]
        name = F.struct("variant", "tree", "class")
        between = lambda x: F.struct(*[F.lit(v) for v in x])
        some = trees.where((name >= between(first)) & (name <= between(last))) if len(groups) > 1 else trees
        table = some.withColumnRenamed("class", "klass").toPandas()
        yield [(int(r.variant), int(r.klass), T.Tree.unpacked(r, group[0]["outputs"])) for r in table.itertuples()]


class TreeModel(Transformer, MLWritable, MLReadable):
    """A fitted ensemble: adds ``prediction``, and ``probability`` per class, from ``features``."""

    def __init__(self, trees: DataFrame | None = None, layout: T.Layout | None = None, spec: Ensemble | None = None, base: Sequence[float] = ()):
        super().__init__()
        self.trees, self.layout, self.spec, self.base = trees, layout, spec, list(base)

    def _sums(self, df: DataFrame) -> DataFrame:
        """``__sums``: what the trees add up to per class; a pass over the rows for every chunk of trees."""
        layout, outputs = self.layout, self.spec.outputs
        rate = 1.0 / self.spec.trees if self.spec.kind == "forest" else self.spec.rate
        base = F.array(*[F.lit(float(b)) for b in self.base])
        out = df.withColumn("__sums", base)
        for n, chunk in enumerate(tree_chunks(self.trees)):
            if n:  # the sums so far are stored, so that a worker holds one chunk
                out = stored(out, "partial-sums")
            sent = df.sparkSession.sparkContext.broadcast(chunk)

            @F.pandas_udf("array<double>")
            def added(x: pd.Series) -> pd.Series:
                bins = layout.bins(np.stack(x.to_numpy()))
                total = np.zeros((bins.shape[1], outputs))
                for _, c, tree in sent.value:
                    value = tree.value[tree.leaves(bins)]
                    if value.shape[1] == outputs:
                        total += value
                    else:
                        total[:, c] += value[:, 0]
                return pd.Series(list(rate * total))

            out = out.withColumn("__sums", F.zip_with("__sums", added(feature_values(df)), lambda a, b: a + b))
        return out

    def _transform(self, df: DataFrame) -> DataFrame:
        out = self._sums(df)
        sums = F.col("__sums")
        if not self.spec.classes:
            return out.withColumn("prediction", sums[0]).drop("__sums")
        if self.spec.kind == "forest":
            odds = sums
        else:
            odds = F.transform(sums, lambda m: F.exp(m - F.array_max("__sums")))
        total = F.aggregate(odds, F.lit(0.0), lambda a, b: a + b)
        share = F.transform(odds, lambda p: p / total) if self.spec.kind != "forest" else odds
        out = out.withColumn("probability", share)
        best = F.array_position("probability", F.array_max("probability")) - 1
        return out.withColumn("prediction", best.cast("double")).drop("__sums")

    def importances(self) -> DataFrame:
        """``(feature, importance)`` by number: gains per tree as shares, averaged over the trees that split.

        Trees drawn on columns count a feature's mean gain instead, as second-order boosting does.
        """
        features, mean = len(self.layout.edges), self.spec.column_share < 1

        def run(batches):
            for batch in batches:
                out = []
                for row in batch.itertuples():
                    feature, gain = np.frombuffer(row.feature, "<i2"), np.frombuffer(row.gain, "<f8")
                    inner = feature >= 0
                    total = np.bincount(feature[inner], gain[inner], features)
                    splits = np.bincount(feature[inner], minlength=features)
                    share = total if mean else total / total.sum() if total.sum() else total
                    out += [(f, float(share[f]), float(splits[f])) for f in range(features)]
                yield pd.DataFrame(out, columns=["feature", "gain", "splits"])

        parts = self.trees.select("feature", "gain").mapInPandas(run, "feature int, gain double, splits double")
        value = F.coalesce(F.try_divide(F.sum("gain"), F.sum("splits")), F.lit(0.0)) if mean else F.sum("gain")
        found = parts.groupBy("feature").agg(value.alias("gain"))
        whole = found.agg(F.sum("gain").alias("all"))
        return found.crossJoin(whole).select("feature", F.coalesce(F.try_divide(F.col("gain"), F.col("all")), F.lit(0.0)).alias("importance"))

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)


class _Writer(MLWriter):
    def __init__(self, model: TreeModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        m = self.model
        extra = {"spec": asdict(m.spec), "edges": m.layout.edges, "base": m.base}
        DefaultParamsWriter.saveMetadata(m, path, self.sparkSession, extraMetadata=extra)
        m.trees.write.mode("overwrite").parquet(f"{path}/trees")


class _Reader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> TreeModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        spec = Ensemble(**{**metadata["spec"], "growth": T.Growth(**metadata["spec"]["growth"])})
        layout = T.Layout(tuple(map(tuple, metadata["edges"])))
        model = self.cls(self.sparkSession.read.parquet(f"{path}/trees"), layout, spec, metadata["base"])
        model._resetUid(metadata["uid"])
        return model
