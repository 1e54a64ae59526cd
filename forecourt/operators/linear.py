"""Least squares, ridge and lasso from moments: one scan for all models and all folds."""

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Transformer
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.functions.numeric import feature_values

#: Sweeps of coordinate descent at most, and the change that ends it.
SWEEPS, TOLERANCE = 10_000, 1e-12


def fold_moments(df: DataFrame, label: str, fold: Column | None = None, train: Column | None = None) -> dict[tuple[int, bool], np.ndarray]:
    """Per (fold, train): the sums of products of (1, features, label), as one matrix.

    One scan; a task sends a matrix for each pair, so what is shuffled and collected does not depend on the rows.
    """

    def run(batches):
        held: dict[tuple[int, bool], np.ndarray] = {}
        for batch in batches:
            x = batch.column(0).flatten().to_numpy().reshape(batch.num_rows, -1)
            y, fold, train = (batch.column(c).to_numpy(zero_copy_only=False) for c in (1, 2, 3))
            z = np.column_stack([np.ones(len(y)), x, y])
            for f in np.unique(fold):
                for t in (False, True):
                    part = z[(fold == f) & (train == t)]
                    if len(part):
                        held[int(f), t] = held.get((int(f), t), 0.0) + part.T @ part
        rows = [(f, t, p, v) for (f, t), m in held.items() for p, v in enumerate(m.ravel().tolist())]
        columns = list(zip(*rows)) or [[]] * 4
        kinds = (pa.int32(), pa.bool_(), pa.int32(), pa.float64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["fold", "train", "place", "value"])

    chosen = df.select(
        feature_values(df).alias("x"), F.col(label).cast("double").alias("y"),
        (F.lit(-1) if fold is None else fold).cast("int").alias("fold"), (F.lit(True) if train is None else train).alias("train"),
    )
    parts = chosen.mapInArrow(run, "fold int, train boolean, place int, value double")
    rows = parts.groupBy("fold", "train", "place").agg(F.sum("value").alias("value")).orderBy("fold", "train", "place").collect()
    found: dict[tuple[int, bool], list[float]] = {}
    for r in rows:
        found.setdefault((r["fold"], r["train"]), []).append(r["value"])
    return {k: np.array(v).reshape(int(len(v) ** 0.5), -1) for k, v in found.items()}


@dataclass(frozen=True)
class Linear:
    """``penalty`` on the summed squared error for ``ridge``, on half its mean for ``lasso``; none for ``ols``.

    The first ``scaled`` features are brought to unit deviation before penalties apply.
    """

    kind: str
    label: str
    penalty: float = 0.0
    scaled: int = 0

    def solve(self, moments: np.ndarray) -> tuple[np.ndarray, float]:
        """Coefficients and intercept. Of least squares with dependent features the shortest solution."""
        n = moments[0, 0]
        mean = moments[0, 1:] / n
        covariance = moments[1:, 1:] / n - np.outer(mean, mean)
        deviation = np.sqrt(np.maximum(np.diag(covariance)[:-1], 0.0))
        scale = np.where((np.arange(len(deviation)) < self.scaled) & (deviation > 1e-12), deviation, 1.0)
        s, t = covariance[:-1, :-1] / np.outer(scale, scale), covariance[:-1, -1] / scale
        if self.kind == "lasso":
            w = self._descend(s, t)
        elif self.kind == "ridge":
            w = np.linalg.solve(s + self.penalty / n * np.eye(len(t)), t)
        else:
            w = np.linalg.pinv(s, rcond=1e-10, hermitian=True) @ t
        w = w / scale
        return w, float(mean[-1] - w @ mean[:-1])

    def _descend(self, s: np.ndarray, t: np.ndarray) -> np.ndarray:
        """Coordinate descent: a coefficient at a time to its best value, nought while its gradient is within the penalty."""
        w = np.zeros(len(t))
        for _ in range(SWEEPS):
            before = w.copy()
            for j in np.flatnonzero(np.diag(s) > 1e-12):
                pull = t[j] - s[j] @ w + s[j, j] * w[j]
                w[j] = np.sign(pull) * max(abs(pull) - self.penalty, 0.0) / s[j, j]
            if np.abs(w - before).max(initial=0.0) <= TOLERANCE:
                break
        return w

    def model(self, moments: np.ndarray) -> "LinearModel":
        return LinearModel(*self.solve(moments))

    def fit(self, df: DataFrame) -> "LinearModel":
        return self.model(sum(fold_moments(df, self.label).values()))


def r2(moments: np.ndarray, coefficients: Sequence[float], intercept: float) -> float | None:
    """R² of a linear model on the rows of some moments."""
    v = np.concatenate([[-intercept], -np.asarray(coefficients), [1.0]])
    total = moments[-1, -1] - moments[0, -1] ** 2 / moments[0, 0]
    return float(1 - v @ moments @ v / total) if total > 0 else None


def fold_scores(moments: dict[tuple[int, bool], np.ndarray], spec: Linear) -> list[float]:
    """R² on every fold of the model of all other rows, whose moments are the sum less the fold's."""
    whole = sum(moments.values())
    scores = []
    for fold in sorted({f for f, _ in moments}):
        left_out = sum(m for (f, _), m in moments.items() if f == fold)
        score = r2(left_out, *spec.solve(whole - left_out))
        scores += [] if score is None else [score]
    return scores


class LinearModel(Transformer, MLWritable, MLReadable):
    """Adds ``prediction``, a plain projection of ``features``."""

    def __init__(self, coefficients: Sequence[float] = (), intercept: float = 0.0):
        super().__init__()
        self._coefficients, self.intercept = [float(c) for c in coefficients], float(intercept)

    @property
    def coefficients(self) -> DenseVector:
        return Vectors.dense(self._coefficients)

    def _transform(self, df: DataFrame) -> DataFrame:
        weights = F.array(*[F.lit(c) for c in self._coefficients])
        products = F.zip_with(feature_values(df), weights, lambda x, w: x * w)
        return df.withColumn("prediction", F.aggregate(products, F.lit(self.intercept), lambda a, b: a + b))

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)


class _Writer(MLWriter):
    def __init__(self, model: LinearModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        extra = {"coefficients": self.model._coefficients, "intercept": self.model.intercept}
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession, extraMetadata=extra)


class _Reader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> LinearModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.cls(metadata["coefficients"], metadata["intercept"])
        model._resetUid(metadata["uid"])
        return model
