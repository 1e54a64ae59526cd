"""Whitening of embeddings, from a covariance by polarisation over exact whole numbers."""

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: An entry c becomes the whole number floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 1024, 100_000
#: Rows that are worked on together.
ROWS = 4096


def usable(df: DataFrame, vec_col: str) -> DataFrame:
    """The rows whose vector has entries, all of them present and finite."""
    entries = F.col(vec_col).cast("array<double>")
    fine = F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return df.withColumn(vec_col, entries).where(fine & (F.size(entries) > 0))


def _whole(column: pa.Array) -> np.ndarray:
    """Whole numbers of a block of vectors, one per row."""
    sizes = np.diff(column.offsets.to_numpy())
    if len(set(sizes.tolist())) > 1:
        raise ValueError("vectors of one table must have one length")
    scaled = np.floor(column.flatten().to_numpy().reshape(len(sizes), -1) * float(SCALE))
    if (np.abs(scaled) >= 2.0**62).any():
        raise ValueError("an entry is too large for a whole number of 64 bits")
    return scaled.astype(np.int64) + SHIFT


def _exact(values: np.ndarray, largest: int) -> np.ndarray:
    """``values`` as Python's numbers where a result up to ``largest`` has no room in 64 bits."""
    return values if largest < 2**63 else values.astype(object)


def _blocks(batches):
    for batch in batches:
        column = batch.column(batch.num_columns - 1)
        for at in range(0, len(column), ROWS):
            yield batch.slice(at, ROWS), _whole(pa.concat_arrays([column.slice(at, ROWS)]))


def exact_sums(df: DataFrame, vec_col: str, per_block: Callable[[np.ndarray], np.ndarray]) -> list[int]:
    """Sums over all blocks of the arrays of whole numbers that ``per_block`` makes.

    Every task adds its blocks up in unbounded numbers and gives one row for each place, which Spark adds as
    decimals of 38 digits; what reaches the driver has the size of one array.
    """

    def run(batches):
        total: list[int] | None = None
        for _, x in _blocks(batches):
            found = [int(v) for v in per_block(x)]
            total = found if total is None else [a + b for a, b in zip(total, found, strict=True)]
        names = ["place", "total"]
        rows = [] if total is None else [str(v) for v in total]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(rows)), pa.int32()), pa.array(rows, pa.string())], names)

    parts = df.select(vec_col).mapInArrow(run, "place int, total string")
    added = parts.groupBy("place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    return [int(r["total"]) for r in sorted(added, key=lambda r: r["place"])]


def pair_sums(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Sums of squares of every centred dimension, then of every sum of two, in the order of (i, j > i)."""
    d = x - centre
    largest = int(np.abs(d).max(initial=0))
    d = _exact(d, 4 * largest * largest * len(d))
    out = [(d * d).sum(axis=0)]
    for i in range(d.shape[1] - 1):
        both = d[:, i : i + 1] + d[:, i + 1 :]
        out.append((both * both).sum(axis=0))
    return np.concatenate(out)


@dataclass
class Whitening:
    """What whitening needs: rows, sums per dimension, covariance, and its components by falling eigenvalue."""

    n: int
    sums: list[int]
    covariance: np.ndarray
    eigenvalues: np.ndarray
    components: np.ndarray

    @property
    def trace(self) -> float:
        return float(np.trace(self.covariance))


def fit(df: DataFrame, vec_col: str = "embedding", components: int = 8) -> Whitening | None:
    """Exact sums, covariance by polarisation and its first components; None if no vector is usable.

    The variance of a sum of two dimensions is that of each and twice their covariance, so
    squares of centred values of every dimension and pair are all that is added up. Values are centred by
    the whole part of their mean, and the rest is corrected in exact arithmetic: with D the value so
    centred and r = S - n * centre, the sum of (n*x - S)^2 is n^2 * sum(D^2) - n * r^2. Only the eigenvectors
    are floating-point. Components without variance in double precision are left out.
    """
    rows = usable(df, vec_col)
    found = exact_sums(rows, vec_col, lambda x: np.concatenate([[len(x)], _exact(x, int(np.abs(x).max()) * len(x)).sum(axis=0)]))
    if not found:
        return None
    n, sums = found[0], found[1:]
    size = len(sums)
    centre = [s // n for s in sums]
    rest = [s - n * m for s, m in zip(sums, centre)]
    at = np.array(centre, np.int64)
    squares = exact_sums(rows, vec_col, lambda x: pair_sums(x, at))
    single = [n * n * q - n * r * r for q, r in zip(squares, rest)]
    covariance = np.zeros((size, size))
    pairs = iter(squares[size:])
    for i in range(size):
        covariance[i, i] = single[i] / n**3
        for j in range(i + 1, size):
            both = n * n * next(pairs) - n * (rest[i] + rest[j]) ** 2
            covariance[i, j] = covariance[j, i] = (both - single[i] - single[j]) / (2 * n**3)
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")[:components]
    order = order[values[order] > max(values.max(), 0.0) * size * np.finfo(float).eps]
    return Whitening(n, sums, covariance, values[order], vectors[:, order].T)


def _centred(x: np.ndarray, model: Whitening) -> np.ndarray:
    """n*x - S, exact."""
    largest = model.n * int(np.abs(x).max(initial=0)) + max(map(abs, model.sums))
    x = _exact(x, largest * largest * x.shape[1])
    return x * model.n - np.array(model.sums, x.dtype)


def _whitened(centred: np.ndarray, model: Whitening) -> np.ndarray:
    return (centred.astype(float) / model.n) @ (model.components / np.sqrt(model.eigenvalues)[:, None]).T


def identity_error(df: DataFrame, model: Whitening, vec_col: str = "embedding") -> float:
    """The largest absolute entry of the whitened rows' covariance less the identity, measured on the rows."""
    k = len(model.eigenvalues)

    def run(batches):
        total = np.zeros(k * k + k)
        for _, x in _blocks(batches):
            w = _whitened(_centred(x, model), model)
            total += np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total)], ["place", "total"])

    parts = usable(df, vec_col).select(vec_col).mapInArrow(run, "place int, total double")
    rows = sorted(parts.groupBy("place").agg(F.sum("total").alias("total")).collect())
    total = np.array([r["total"] for r in rows]) / model.n
    mean, square = total[:k], total[k:].reshape(k, k)
    return float(np.abs(square - np.outer(mean, mean) - np.eye(k)).max())


def whiten(df: DataFrame, components: int = 8, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``(id, component, n, deviation, whitened, explained, identity_error)`` per usable row and component.

    Rows whose vector is null, empty or has null or non-finite entries are dropped. Repeated rows and
    rows without an id have their own rows; other columns are left out. ``deviation`` is the exact
    sum over dimensions of (n*x - S)^2, a decimal. A table without usable rows or variance gives no rows;
    vectors of different lengths raise an error.
    """
    chosen = df.select(F.col(id_col).alias("id"), F.col(vec_col).alias("vector"))
    id_type = chosen.schema["id"].dataType.simpleString()
    schema = f"id {id_type}, component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double"
    model = fit(chosen, "vector", components)
    if model is None or not len(model.eigenvalues):
        return df.sparkSession.createDataFrame([], schema).withColumnRenamed("id", id_col)
    error = identity_error(chosen, model, "vector")
    k = len(model.eigenvalues)
    shares = model.eigenvalues / model.trace

    def run(batches):
        for batch, x in _blocks(batches):
            centred = _centred(x, model)
            size = centred * centred
            deviation = pa.array([int(v) for v in size.sum(axis=1)], pa.decimal128(38, 0))
            rows, m = np.repeat(np.arange(len(x)), k), len(x)
            columns = [
                batch.column(0).take(pa.array(rows)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(np.full(m * k, model.n)), deviation.take(pa.array(rows)), pa.array(_whitened(centred, model).ravel()),
                pa.array(np.tile(shares, m)), pa.array(np.full(m * k, error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return usable(chosen, "vector").mapInArrow(run, schema).withColumnRenamed("id", id_col)
