"""Growing trees over a stored matrix of binned features, all trees of a job side by side.

The matrix is a table of blocks: a row holds the bins of some thousand listings, column after column,
with their labels. Nodes with many rows are split by histograms that tasks make of their blocks and
Spark adds up by (tree, node); a child's histogram is also its parent's less its sibling's. As
soon as a node has few enough rows, they are shuffled to one group, which completes its subtree.
"""

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from functools import cached_property
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.functions.numeric import feature_values
from forecourt.session import discard, stored

#: Bins of a feature at most, rows of a block, and rows that one group completes: about 6 MB.
BINS, BLOCK, LOCAL_ROWS = 64, 16_384, 1 << 17
#: Rows of a node up to which sorting them costs less than cells of all features, if few features are drawn.
FEW = 128
#: Cells that are compared together, bytes of histograms that a task holds, and bytes that all tasks may send to the driver together.
CELLS, HELD, SENT = 1 << 21, 256 << 20, 64 << 20
#: A split must gain more than rounding errors do.
LEAST_GAIN = 1e-9


@dataclass(frozen=True)
class Layout:
    """Upper edges of every feature's bins, and where a feature's cells begin among all cells."""

    edges: tuple[tuple[float, ...], ...]

    @cached_property
    def offsets(self) -> np.ndarray:
        return np.concatenate(([0], np.cumsum([len(e) + 1 for e in self.edges])))

    @cached_property
    def feature_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.edges)), [len(e) + 1 for e in self.edges])

    def bins(self, x: np.ndarray) -> np.ndarray:
        """Rows of values to features of bins; a value on an edge lies below it."""
        return np.stack([np.searchsorted(np.asarray(e), x[:, f], "left") for f, e in enumerate(self.edges)]).astype(np.uint8)


def fit_layout(df: DataFrame, size: int, features: str = "features", bins: int = BINS) -> Layout:
    """Bins of about equal counts: one scan, one sketch per feature.

    A feature with few values, none of them rarer than a bin, has a bin for each.
    """
    x = feature_values(df, features)
    asked = F.array(*[F.lit(k / bins) for k in range(1, bins + 1)])
    row = df.select(x.alias("x")).agg(*[F.percentile_approx(F.col("x")[f], asked, 10_000).alias(f"e{f}") for f in range(size)]).first()
    return Layout(tuple(tuple(sorted(set(row[f"e{f}"] or ()))[:-1]) for f in range(size)))


_MATRIX = "n int, keys binary, bins binary, y binary, fold binary, train binary"


def build_matrix(
    df: DataFrame, layout: Layout, label: str, key: Column, fold: Column, train: Column, features: str = "features",
) -> DataFrame:
    """The stored block table: 64-bit row keys, bins, labels, folds, and whether a row is trained on."""

    def run(batches):
        held: list[tuple] = []

        def block():
            x, y, key, fold, train = map(np.concatenate, zip(*held))
            held.clear()
            arrays = [key.astype("<i8"), layout.bins(x), y.astype("<f8"), fold.astype("i1"), train.astype("u1")]
            return pa.RecordBatch.from_arrays(
                [pa.array([len(y)], pa.int32())] + [pa.array([a.tobytes()], pa.binary()) for a in arrays], _names(_MATRIX))

        for batch in batches:
            x = batch.column(0).flatten().to_numpy().reshape(batch.num_rows, -1)
            held.append((x, *(batch.column(c).to_numpy(zero_copy_only=False) for c in range(1, 5))))
            if sum(len(h[1]) for h in held) >= BLOCK:
                yield block()
        if held and sum(len(h[1]) for h in held):
            yield block()

    chosen = df.select(
        feature_values(df, features).alias("x"), F.col(label).cast("double").alias("y"), key.cast("bigint").alias("key"),
        fold.cast("int").alias("fold"), train.cast("boolean").alias("train"),
    )
    matrix = stored(chosen.mapInArrow(run, _MATRIX), "matrix")
    parts, cores = matrix.rdd.getNumPartitions(), matrix.sparkSession.sparkContext.defaultParallelism
    if parts % cores == 0 or parts >= 4 * cores:
        return matrix
    even = stored(matrix.repartition(cores), "matrix")  # else some cores idle in every scan of the many that follow
    discard(matrix)
    return even


def _names(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(", ")]


_KINDS = {"int": pa.int32(), "bigint": pa.int64(), "double": pa.float64(), "binary": pa.binary(), "string": pa.string()}


def arrow_rows(rows: Sequence[tuple], schema: str) -> pa.RecordBatch:
    """Tuples as a batch under a schema such as ``"n int, y double"``."""
    columns = list(zip(*rows)) or [()] * len(_names(schema))
    kinds = [_KINDS[part.split()[1]] for part in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], _names(schema))


@dataclass
class Block:
    """A row of the matrix as arrays; ``margin`` is what boosting keeps: (models, rows)."""

    n: int
    keys: np.ndarray
    bins: np.ndarray
    y: np.ndarray
    fold: np.ndarray
    train: np.ndarray
    margin: np.ndarray | None = None

    @classmethod
    def of(cls, row, features: int) -> "Block":
        margin = getattr(row, "margin", None)
        return cls(
            row.n, np.frombuffer(row.keys, "<u8"), np.frombuffer(row.bins, "u1").reshape(features, row.n), np.frombuffer(row.y, "<f8"),
            np.frombuffer(row.fold, "i1"), np.frombuffer(row.train, "u1").astype(bool),
            None if margin is None else np.frombuffer(margin, "<f8").reshape(-1, row.n).copy(),
        )

    @classmethod
    def each(cls, batches, features: int) -> "Iterator[Block]":
        """The blocks of Arrow batches, one at a time: a worker holds a batch and one block, not the batch a second time."""
        for batch in batches:
            names = batch.schema.names
            for i in range(batch.num_rows):
                cells = ((c, batch.column(c)[i]) for c in names)
                yield cls.of(SimpleNamespace(**{c: v.as_py() if c == "n" else v.as_buffer() for c, v in cells}), features)

    def seen(self, variant: int) -> np.ndarray:
        """Rows that a variant learns from: the train split, or all rows outside fold ``variant``."""
        return self.train if variant < 0 else self.fold != variant


def mixed(keys: np.ndarray, salt: int) -> np.ndarray:
    """Numbers in [0, 1) fixed by row key and salt: the finaliser of a 64-bit hash."""
    with np.errstate(over="ignore"):
        z = keys + np.uint64((salt * 0x9E3779B97F4A7C15) % 2**64)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return ((z ^ (z >> np.uint64(31))) >> np.uint64(11)).astype(float) / float(1 << 53)


@dataclass(frozen=True)
class Growth:
    """When to split. Rows are counted once, weights and curvatures added; ``penalty`` shrinks leaves.

    ``node_features`` of the features that can split a node are drawn for each node; all if None.
    A leaf is ``scale`` times the gradient sum over weight plus penalty, or over the last statistic if ``own_curvature``.
    If ``labelled``, rows bring the number of their class instead of a gradient for each class.
    """

    max_depth: int
    min_split: int = 2
    min_leaf: int = 1
    min_weight: float = 0.0
    penalty: float = 0.0
    node_features: int | None = None
    classes: int = 1
    own_curvature: bool = False
    scale: float = 1.0
    labelled: bool = False

    @property
    def one_hot(self) -> int:
        """Classes that the last statistic numbers; 0 if it is a sum like the others."""
        return self.classes if self.labelled else 0

    def leaf(self, totals: np.ndarray) -> np.ndarray:
        """Values, one column per gradient, of nodes' totals (count, weight, gradients, maybe curvature)."""
        below = totals[:, -1] if self.own_curvature else totals[:, 1] + self.penalty
        safe = np.where(np.abs(below) > 1e-150, below, 1.0)
        return np.where(np.abs(below)[:, None] > 1e-150, self.scale * totals[:, 2 : 2 + self.classes] / safe[:, None], 0.0)


@dataclass
class Tree:
    """Nodes in arrays. Children are neighbours: rows with a bin up to ``cut`` go left. -1: a leaf."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    value: np.ndarray
    gain: np.ndarray

    def leaves(self, bins: np.ndarray, rows: np.ndarray | None = None) -> np.ndarray:
        """The leaf of every row, or of some rows by number."""
        n = bins.shape[1]
        column = np.arange(n) if rows is None else rows
        at = np.zeros(len(column), np.int32)
        if len(self.feature) == 1:
            return at
        flat, begins = bins.reshape(-1), self.feature.astype(np.int64) * n
        live, node = np.arange(len(column)), at.copy()
        while len(live):
            begin = begins.take(node)
            inner = begin >= 0
            if not inner.all():
                at[live[~inner]] = node[~inner]
                live, column, node, begin = live[inner], column[inner], node[inner], begin[inner]
            node = self.left.take(node) + (flat.take(begin + column) > self.cut.take(node))
        return at

    def grafted(self, parts: "dict[int, Tree]") -> "Tree":
        """This tree with the roots of ``parts`` in place of the leaves they are named after."""
        whole = [np.array(a) for a in (self.feature, self.cut, self.left, self.value, self.gain)]
        for leaf, part in sorted(parts.items()):
            shift = len(whole[0]) - 1  # the part's root goes to the leaf's place, the others behind all there is
            left = np.where(part.feature >= 0, part.left + shift, -1).astype(np.int32)
            for mine, new in zip(whole, (part.feature, part.cut, left, part.value, part.gain)):
                mine[leaf] = new[0]
            whole = [np.concatenate([a, new[1:]]) for a, new in zip(whole, (part.feature, part.cut, left, part.value, part.gain))]
        return Tree(*whole)

    def packed(self) -> tuple[bytes, ...]:
        kinds = ("<i2", "u1", "<i4", "<f8", "<f8")
        return tuple(np.ascontiguousarray(a, k).tobytes() for a, k in zip((self.feature, self.cut, self.left, self.value, self.gain), kinds))

    @classmethod
    def unpacked(cls, row, classes: int) -> "Tree":
        read = [np.frombuffer(getattr(row, c), k) for c, k in zip(_ARRAYS, ("<i2", "u1", "<i4", "<f8", "<f8"))]
        read[3] = read[3].reshape(-1, classes)
        return cls(*read)


_ARRAYS = ("feature", "cut", "left", "value", "gain")
PARTS = "key int, node int, " + ", ".join(f"{c} binary" for c in _ARRAYS)


def sums(key: np.ndarray, size: int, stats: list, classes: int = 0) -> Iterator[np.ndarray]:
    """Every statistic added by key; one that is None is the count.

    With ``classes`` the statistics are None, weights and class numbers, which stand for one sum of weights per class.
    """
    count = np.bincount(key, minlength=size)
    if not classes:
        yield from (count if v is None else np.bincount(key, v, size) for v in stats)
        return
    each = np.bincount(key * classes + stats[2], stats[1], size * classes).reshape(size, classes)
    yield count
    yield each.sum(axis=1)  # weights are whole numbers: their sum is exact in any order
    yield from each.T


def histogram(bins: np.ndarray, place: np.ndarray, size: int, stats: list, layout: Layout, classes: int = 0) -> np.ndarray:
    """(size, cells, statistics): :func:`sums` per place and bin, a feature at a time, whose keys fit a processor's cache."""
    offsets, place = layout.offsets, place.astype(np.int64)
    out = np.empty((size, int(offsets[-1]), 2 + classes if classes else len(stats)))
    for f, (low, high) in enumerate(zip(offsets[:-1], offsets[1:])):
        key = place * (high - low) + bins[f]
        for c, v in enumerate(sums(key, size * int(high - low), stats, classes)):
            out[:, low:high, c] = v.reshape(size, -1)
    return out


def best_splits(hist: np.ndarray, growth: Growth, layout: Layout, allowed: np.ndarray, order: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """(feature, cut, gain, statistics on the left) of every histogram; of equal gains the first cell's.

    ``order`` has a random number for every node and feature, if only some features are drawn.
    """
    step = max(1, CELLS // (hist.shape[1] * hist.shape[2]))
    found = [_best(hist[at : at + step], growth, layout, allowed, None if order is None else order[at : at + step]) for at in range(0, len(hist), step)]
    return tuple(map(np.concatenate, zip(*found)))


def _best(hist, growth, layout, allowed, order):
    offsets, feature_of = layout.offsets, layout.feature_of
    h = np.ascontiguousarray(np.moveaxis(hist, 2, 0))  # (statistics, nodes, cells)
    total = h[:, :, : offsets[1]].sum(axis=2)
    h[:, :, offsets[1:-1]] -= total[:, :, None]  # every feature's cells add up to the total, so sums start anew
    left = np.cumsum(h, axis=2, out=h)
    fine = (left[0] >= growth.min_leaf) & (left[0] <= (total[0] - growth.min_leaf)[:, None])
    fine &= allowed[feature_of] & (total[0] >= growth.min_split)[:, None]
    if growth.min_weight:
        fine &= (left[1] >= growth.min_weight) & (left[1] <= (total[1] - growth.min_weight)[:, None])
    if growth.node_features:
        fine &= _drawn(order, np.logical_or.reduceat(fine, offsets[:-1], axis=1), growth.node_features)[:, feature_of]
    with np.errstate(divide="ignore", invalid="ignore"):
        below, above = 1.0 / (left[1] + growth.penalty), 1.0 / (total[1][:, None] - left[1] + growth.penalty)
        score, whole = np.zeros_like(below), np.zeros(len(hist))
        for g, all_ in zip(left[2 : 2 + growth.classes], total[2:]):
            score += g * g * below
            score += (all_[:, None] - g) ** 2 * above
            whole += all_ * all_ / (total[1] + growth.penalty)
    score[~fine] = -np.inf
    cell = score.argmax(axis=1)
    rows = np.arange(len(hist))
    feature = feature_of[cell]
    return feature.astype(np.int16), (cell - offsets[feature]).astype(np.uint8), score[rows, cell] - whole, left[:, rows, cell].T


def _drawn(order: np.ndarray, can: np.ndarray, wanted: int) -> np.ndarray:
    """The ``wanted`` features of each node with the lowest numbers among those that can split it."""
    order = np.where(can, order, 2.0)
    k = min(wanted, order.shape[1]) - 1
    return order <= np.partition(order, k, axis=1)[:, k : k + 1]


def few_rows_splits(
    bins: np.ndarray, place: np.ndarray, size: int, stats: list, growth: Growth, allowed: np.ndarray, order: np.ndarray,
) -> tuple[np.ndarray, ...]:
    """(feature, cut, gain) as :func:`best_splits` finds them, for nodes of few rows with numbered classes and leaves of any size.

    Only the drawn features' bins are looked at, sorted within each node.
    """
    _, w, label = stats
    by = np.argsort(place, kind="stable")
    b, w, label = bins[:, by], w[by], label[by]
    rows_of = np.bincount(place, minlength=size)
    first = np.concatenate(([0], np.cumsum(rows_of)[:-1]))
    can = (np.minimum.reduceat(b, first, axis=1) < np.maximum.reduceat(b, first, axis=1)).T & allowed
    node, feature = np.nonzero(_drawn(order, can, growth.node_features) & can)
    gain, cut, chosen = np.full(size, -np.inf), np.zeros(size, np.uint8), np.zeros(size, np.int16)
    if not len(node):
        return chosen, cut, gain
    n = rows_of[node]
    pair = np.repeat(np.arange(len(node)), n)
    row = np.arange(len(pair)) + np.repeat(first[node] - np.cumsum(n) + n, n)
    key = pair * 256 + b[feature[pair], row]
    by = np.argsort(key)
    key, row = key[by], row[by]
    starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))  # a cell: a node's rows in one bin of a feature
    cell = np.repeat(np.arange(len(starts)), np.diff(starts, append=len(key)))
    classes, of_pair = growth.classes, key[starts] >> 8
    left = np.bincount(cell * classes + label[row], w[row], len(starts) * classes).reshape(-1, classes).cumsum(axis=0)
    last = np.flatnonzero(np.concatenate((of_pair[1:] != of_pair[:-1], [True])))
    before = np.concatenate((np.zeros((1, classes)), left[last[:-1]]))
    total = (left[last] - before)[of_pair]
    left -= before[of_pair]
    keep = np.ones(len(starts), bool)
    keep[last] = False  # nothing would be on the right
    left, total, of_pair, at = left[keep], total[keep], of_pair[keep], key[starts[keep]] & 255
    weight, all_weight = left.sum(axis=1), total.sum(axis=1)
    below, above = 1.0 / (weight + growth.penalty), 1.0 / (all_weight - weight + growth.penalty)
    score, whole = np.zeros_like(below), np.zeros_like(below)
    for g, all_ in zip(left.T, total.T):
        score += g * g * below
        score += (all_ - g) ** 2 * above
        whole += all_ * all_ / (all_weight + growth.penalty)
    of_node = node[of_pair]
    np.maximum.at(gain, of_node, score)
    best = np.flatnonzero(score == gain[of_node])[::-1]  # of equal gains the first cell's
    gain[of_node[best]] = score[best] - whole[best]
    chosen[of_node[best]], cut[of_node[best]] = feature[of_pair[best]], at[best]
    return chosen, cut, gain


def grow_local(bins: np.ndarray, stats: list, growth: Growth, layout: Layout, allowed: np.ndarray, rng=None) -> Tree:
    """A tree over the rows at hand, level by level; histograms of larger children come by subtraction."""
    n = bins.shape[1]
    most = 2 * n + 1
    feature, cut, left = np.full(most, -1, np.int16), np.zeros(most, np.uint8), np.full(most, -1, np.int32)
    gain, at = np.zeros(most), np.zeros(n, np.int32)
    ids, rows, place, used, depth = np.zeros(1, np.int64), np.arange(n), np.zeros(n, np.int64), 1, 0
    few = FEW if growth.labelled and growth.node_features and growth.min_leaf == 1 and not growth.min_weight else 0
    taken = lambda mine: [v if v is None else v[mine] for v in stats]
    many = np.array([n > few])  # the nodes that have a histogram
    hist = histogram(bins, place, 1, stats, layout, growth.one_hot)[many] if growth.max_depth and n >= growth.min_split else None
    while hist is not None and len(ids):
        order = rng.random((len(ids), len(bins))) if growth.node_features else None
        f, c, g = np.zeros(len(ids), np.int16), np.zeros(len(ids), np.uint8), np.full(len(ids), -np.inf)
        if many.any():
            f[many], c[many], g[many], _ = best_splits(hist, growth, layout, allowed, None if order is None else order[many])
        if not many.all():
            slot = np.cumsum(~many) - 1
            mine = np.flatnonzero(~many[place])
            f[~many], c[~many], g[~many] = few_rows_splits(
                bins[:, rows[mine]], slot[place[mine]], slot[-1] + 1, taken(rows[mine]), growth, allowed, order[~many])
        split = np.flatnonzero(g > LEAST_GAIN)
        if not len(split):
            break
        children = used + 2 * np.arange(len(split))
        used += 2 * len(split)
        feature[ids[split]], cut[ids[split]], left[ids[split]], gain[ids[split]] = f[split], c[split], children, g[split]
        slot = np.full(len(ids), -1)
        slot[split] = np.arange(len(split))
        keep = slot[place] >= 0
        rows, p = rows[keep], slot[place[keep]]
        goes = (bins[f[split][p], rows] > c[split][p]).astype(np.int64)
        at[rows] = children[p] + goes
        depth += 1
        if depth >= growth.max_depth:
            break
        count = np.bincount(2 * p + goes, minlength=2 * len(split)).reshape(-1, 2)
        open_ = count >= max(growth.min_split, 2 * growth.min_leaf)
        next_many = open_ & (count > few)
        with_hist = np.flatnonzero(next_many.any(axis=1))  # a child with many rows has a parent with many
        both = np.empty((len(with_hist), 2, *hist.shape[1:]))
        if len(with_hist):
            small = (count[:, 0] > count[:, 1]).astype(np.int64)
            slot = np.full(len(split), -1)
            slot[with_hist] = np.arange(len(with_hist))
            mine = (goes == small[p]) & (slot[p] >= 0)
            part = histogram(bins[:, rows[mine]], slot[p[mine]], len(with_hist), taken(rows[mine]), layout, growth.one_hot)
            index, small = np.arange(len(with_hist)), small[with_hist]
            both[index, small], both[index, 1 - small] = part, hist[(np.cumsum(many) - 1)[split[with_hist]]] - part
        hist = both[next_many[with_hist]]
        many, open_ = next_many[open_], open_.ravel()
        ids = (children[:, None] + [0, 1]).ravel()[open_]
        slot = np.full(len(open_), -1)
        slot[open_] = np.arange(len(ids))
        place = slot[2 * p + goes]
        rows, place = rows[place >= 0], place[place >= 0]
    totals = np.stack(list(sums(at.astype(np.int64), used, stats, growth.one_hot)), axis=1)
    return Tree(feature[:used], cut[:used], left[:used], growth.leaf(totals.astype(float)), gain[:used])


@dataclass
class Top:
    """The part of a tree that many rows go through: nodes by number, open ones to split, closed ones to complete."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [-1])
    gain: list[float] = field(default_factory=lambda: [0.0])
    value: dict[int, np.ndarray] = field(default_factory=dict)
    depth: list[int] = field(default_factory=lambda: [0])
    open: list[int] = field(default_factory=list)
    closed: list[int] = field(default_factory=list)

    def tree(self, classes: int) -> Tree:
        value = np.zeros((len(self.feature), classes))
        for node, v in self.value.items():
            value[node] = v
        kinds = (np.int16, np.uint8, np.int32)
        arrays = [np.array(a, k) for a, k in zip((self.feature, self.cut, self.left), kinds)]
        return Tree(*arrays, value, np.array(self.gain))


#: Makes, of a block, the rows and statistics of every tree: (key, row numbers, statistics).
Signal = Callable[[Block], Iterator[tuple[int, np.ndarray, list]]]


def places(spark: SparkSession, n: int) -> list[int]:
    """For each of ``n`` partitions a number that Spark's hash sends there."""
    found = spark.range(64 * n).groupBy(F.pmod(F.hash("id"), F.lit(n)).alias("at")).agg(F.min("id").alias("id")).collect()
    return [r["id"] for r in sorted(found)]


def grow(
    matrix: DataFrame, signal: Signal, keys: Sequence[int], n_rows: int, n_stats: int, layout: Layout, growth: Growth,
    spread: Sequence[int], seed: int = 0, columns: dict[int, np.ndarray] | None = None, local_rows: int = LOCAL_ROWS, tasks: int | None = None,
) -> tuple[DataFrame, dict[int, Top]]:
    """Subtrees ``PARTS`` of the trees ``keys``, still to be run, and the tops they hang from.

    ``n_rows`` bounds the rows of a tree. ``spread`` names a place for each of some partitions. The trees must
    be few enough for a task to hold their open nodes' histograms (:func:`at_once`). Where those of all ``tasks`` that
    scan the matrix are at most ``SENT`` bytes, the driver adds them up and splits the nodes; else Spark does.
    """
    every = np.ones(len(layout.edges), bool)
    columns = columns or {}
    allowed = lambda key: columns.get(key, every)
    tops = {k: Top() for k in keys}
    for top in tops.values():
        (top.closed if n_rows <= local_rows else top.open).append(0)
    last: DataFrame | None = None
    held: dict[tuple[int, int], np.ndarray] = {}
    todo = {(k, 0): -1 for k in keys if tops[k].open}  # nodes to count, and the sibling that subtraction gives
    size = len(tops) * max(1, n_rows // local_rows) * int(layout.offsets[-1]) * n_stats * 8
    while any(top.open for top in tops.values()):
        if tasks and tasks * size <= SENT:
            held = _level_here(matrix, signal, tops, todo, held, n_stats, layout, growth)
            found = _splits(held, layout, growth, seed, allowed)
        else:
            last = stored(_level(matrix, signal, tops, todo, last, n_stats, layout, growth, seed, allowed), "splits")
            found = [tuple(r) for r in last.drop("hist").collect()]
        todo = _decide(found, tops, n_stats, growth, local_rows)
    features = len(layout.edges)
    kind = "<u2" if growth.labelled else "<f8"  # draws and class numbers are small
    rows = _rows_of_closed(matrix, signal, tops, spread, growth.classes, features, kind)

    def finish(group: pd.DataFrame) -> pd.DataFrame:
        key, node = int(group["key"].iloc[0]), int(group["node"].iloc[0])
        group = group.sort_values("first")
        bins = np.concatenate([np.frombuffer(b, "u1").reshape(features, -1) for b in group["bins"]], axis=1)
        parts = [np.frombuffer(b, kind).reshape(-1, n) for b, n in zip(group["stats"], group["n"])]
        values = iter(np.concatenate(parts, axis=1).astype(np.int64 if growth.labelled else float))
        stats = [None if empty else next(values) for empty in map(int, group["none"].iloc[0])]
        left = Growth(**{**growth.__dict__, "max_depth": growth.max_depth - tops_depth[key][node]})
        tree = grow_local(bins, stats, left, layout, allowed(key), np.random.default_rng([seed, key, node]))
        return pd.DataFrame([(key, node, *tree.packed())], columns=["key", "node", *_ARRAYS])

    tops_depth = {k: {n: top.depth[n] for n in top.closed} for k, top in tops.items()}
    placed = rows.repartition(len(spread), "place")
    return placed.groupBy("place", "key", "node").applyInPandas(finish, PARTS), tops


def at_once(n_rows: int, n_stats: int, layout: Layout, local_rows: int = LOCAL_ROWS) -> int:
    """Trees whose open nodes' histograms a task can hold together; open nodes have over ``local_rows`` rows."""
    nodes = max(1, n_rows // local_rows)
    return max(1, HELD // (nodes * int(layout.offsets[-1]) * n_stats * 8))


_COUNTED = "key int, node int, sibling int, hist binary"


def _counted(matrix, signal, tops, todo, layout, growth) -> DataFrame:
    """``_COUNTED``: the histograms of the nodes ``todo`` that each task makes of its blocks."""
    features = len(layout.edges)
    trees = {k: top.tree(growth.classes) for k, top in tops.items() if top.open}
    wanted = {k: sorted(n for key, n in todo if key == k) for k in trees}

    def count(batches):
        held: dict[tuple[int, int], np.ndarray] = {}
        for block in Block.each(batches, features):
            for key, rows, stats in signal(block):
                if not wanted.get(key):
                    continue
                slot = np.full(len(trees[key].feature), -1)
                slot[wanted[key]] = np.arange(len(wanted[key]))
                place = slot[trees[key].leaves(block.bins, rows)]
                mine = place >= 0
                stats = [v if v is None else v[mine] for v in stats]
                made = histogram(block.bins[:, rows[mine]], place[mine], len(wanted[key]), stats, layout, growth.one_hot)
                for node, h in zip(wanted[key], made):
                    held[key, node] = held[key, node] + h if (key, node) in held else h
        yield arrow_rows([(k, n, todo[k, n], h.tobytes()) for (k, n), h in held.items()], _COUNTED)

    return matrix.mapInArrow(count, _COUNTED)


def _level_here(matrix, signal, tops, todo, above, n_stats, layout, growth) -> dict[tuple[int, int], np.ndarray]:
    """Histograms of all open nodes, added up by the driver; those of their parents are ``above``."""
    hists: dict[tuple[int, int], np.ndarray] = {}
    for r in _counted(matrix, signal, tops, todo, layout, growth).collect():
        h = np.frombuffer(r["hist"], "<f8").reshape(int(layout.offsets[-1]), n_stats)
        hists[r["key"], r["node"]] = hists[r["key"], r["node"]] + h if (r["key"], r["node"]) in hists else h
    for (key, node), sibling in todo.items():
        if sibling >= 0:
            parent = tops[key].left.index(min(node, sibling))
            hists[key, sibling] = above[key, parent] - hists[key, node]
    return hists


def _splits(hists: dict[tuple[int, int], np.ndarray], layout: Layout, growth: Growth, seed: int, allowed) -> list[tuple]:
    """(key, node, feature, cut, gain, total, left) of every histogram."""
    out = []
    for (key, node), h in hists.items():
        rng = np.random.default_rng([seed, key, node, 1])
        f, c, g, left = best_splits(h[None], growth, layout, allowed(key), rng.random((1, len(layout.edges))) if growth.node_features else None)
        out.append((key, node, int(f[0]), int(c[0]), float(g[0]), h[: layout.offsets[1]].sum(axis=0).tobytes(), left[0].tobytes()))
    return out


def _level(matrix, signal, tops, todo, last, n_stats, layout, growth, seed, allowed) -> DataFrame:
    """Splits ``(key, node, feature, cut, gain, total, left, hist)`` of all open nodes."""
    rows = _counted(matrix, signal, tops, todo, layout, growth).withColumn("kind", F.lit("child"))
    if last is not None:  # parents of the nodes that are found by subtraction
        pairs = [(k, min(n, s), max(n, s)) for (k, n), s in todo.items() if s >= 0]
        parents = {(k, lo): next(i for i, left in enumerate(tops[k].left) if left == lo) for k, lo, _ in pairs}
        table = pd.DataFrame([(k, p, lo) for (k, lo), p in parents.items()], columns=["key", "node", "lo"]).astype("int32")
        if len(table):
            asked = matrix.sparkSession.createDataFrame(table, "key int, node int, lo int")
            above = last.select("key", "node", "hist").join(F.broadcast(asked), ["key", "node"])
            rows = rows.unionByName(above.select("key", F.col("lo").alias("node"), F.lit(-2).alias("sibling"), "hist", F.lit("parent").alias("kind")))
    family = F.when(F.col("sibling") >= 0, F.least("node", "sibling")).otherwise(F.col("node"))
    shape = (-1, int(layout.offsets[-1]), n_stats)

    def split(group: pd.DataFrame) -> pd.DataFrame:
        key = int(group["key"].iloc[0])
        read = lambda part: sum(np.frombuffer(h, "<f8") for h in part["hist"]).reshape(shape)[0]
        counted, parent = group[group["kind"] == "child"], group[group["kind"] == "parent"]
        hists = {int(n): read(part) for n, part in counted.groupby("node")}
        if len(parent):
            node, sibling = int(counted["node"].iloc[0]), int(counted["sibling"].iloc[0])
            hists[sibling] = read(parent) - hists[node]
        found = _splits({(key, node): h for node, h in hists.items()}, layout, growth, seed, allowed)
        out = [(*split, h.tobytes()) for split, h in zip(found, hists.values())]
        return pd.DataFrame(out, columns=["key", "node", "feature", "cut", "gain", "total", "left", "hist"])

    schema = "key int, node int, feature int, cut int, gain double, total binary, left binary, hist binary"
    return rows.withColumn("family", family).groupBy("key", "family").applyInPandas(split, schema)


def _decide(splits: Sequence[tuple], tops: dict[int, Top], n_stats: int, growth: Growth, local_rows: int) -> dict[tuple[int, int], int]:
    """Split the open nodes of ``tops``; the nodes to count next, each with the sibling it gives by subtraction."""
    for top in tops.values():
        top.open = []
    todo = {}
    for key, node, feature, cut, gain, total, left in sorted(splits):
        top, total, left = tops[key], np.frombuffer(total), np.frombuffer(left)
        below = top.depth[node] + 1
        if gain <= LEAST_GAIN or below > growth.max_depth:
            top.value[node] = growth.leaf(total[None])[0]
            continue
        first = len(top.feature)
        top.feature[node], top.cut[node], top.left[node], top.gain[node] = feature, cut, first, gain
        big = []
        for child, stats in ((first, left), (first + 1, total - left)):
            for column, new in ((top.feature, -1), (top.cut, 0), (top.left, -1), (top.gain, 0.0), (top.depth, below)):
                column.append(new)
            if stats[0] <= local_rows:
                top.closed.append(child)
            elif below >= growth.max_depth:
                top.value[child] = growth.leaf(stats[None])[0]
            else:
                top.open.append(child)
                big.append((stats[0], child))
        if len(big) == 2:
            (_, small), (_, other) = sorted(big)
            todo[key, small] = other
        elif big:
            todo[key, big[0][1]] = -1
    return todo


def _rows_of_closed(matrix: DataFrame, signal: Signal, tops: dict[int, Top], spread: Sequence[int], classes: int, features: int, kind: str) -> DataFrame:
    """The rows of all closed nodes, cut into one piece per block and node."""
    whole = all(len(top.feature) == 1 and top.closed for top in tops.values())
    trees = {} if whole else {k: top.tree(classes) for k, top in tops.items()}
    closed = {k: np.array(sorted(top.closed)) for k, top in tops.items()}

    def run(batches):
        for block in Block.each(batches, features):
            out = []
            for key, rows, stats in signal(block):
                if key not in closed or not len(rows):
                    continue
                if whole:
                    pieces = [(0, rows, slice(None))]
                else:
                    node = trees[key].leaves(block.bins, rows)
                    pieces = [(int(c), rows[node == c], node == c) for c in closed[key] if (node == c).any()]
                none = "".join("1" if v is None else "0" for v in stats)
                for node, mine, mask in pieces:
                    values = [v[mask] for v in stats if v is not None]
                    place = spread[(key + 7 * node) % len(spread)]
                    first = int(block.keys[0] >> np.uint64(1))
                    out.append((place, key, node, first, len(mine), block.bins[:, mine].tobytes(), np.array(values, kind).tobytes(), none))
                    if len(out) >= 64:
                        yield arrow_rows(out, schema)
                        out = []
            yield arrow_rows(out, schema)

    schema = "place bigint, key int, node int, first bigint, n int, bins binary, stats binary, none string"
    return matrix.mapInArrow(run, schema)
