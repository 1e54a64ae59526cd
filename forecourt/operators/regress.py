"""Price regression on the log scale: linear models from moments, forests and boosting over binned features."""

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml import PipelineModel, Transformer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt import schema as S
from forecourt import vocabulary as V
from forecourt.operators import evaluate, linear, prep
from forecourt.operators.ensembles import Ensemble, fit_ensemble
from forecourt.operators.linear import Linear
from forecourt.operators.trees import Growth
from forecourt.session import discard, stored

LABEL = "log_price"

# Model sizes and penalties.
RIDGE_ALPHA = 10.0
LASSO_ALPHA = 100.0
SIZES = {
    "Random Forest": {"numTrees": 300, "maxDepth": 25},
    "Gradient Boosting": {"maxIter": 300, "maxDepth": 8},
    "Subsampled Boosting": {"maxIter": 400, "maxDepth": 10},
}
TREE_MODELS = tuple(SIZES)


def ols(label: str = LABEL, scaled: int = 0) -> Linear:
    return Linear("ols", label, 0.0, scaled)


def ridge(label: str = LABEL, alpha: float = RIDGE_ALPHA, scaled: int = 0) -> Linear:
    """Penalty ``alpha`` on the summed squared error."""
    return Linear("ridge", label, alpha, scaled)


def lasso(label: str = LABEL, alpha: float = LASSO_ALPHA, scaled: int = 0) -> Linear:
    """Penalty ``alpha`` on half the mean squared error."""
    return Linear("lasso", label, alpha, scaled)


def random_forest(label: str = LABEL, numTrees: int = 300, maxDepth: int = 25, seed: int = 42) -> Ensemble:
    """Trees over rows drawn with replacement; every feature may split every node."""
    return Ensemble("forest", numTrees, Growth(maxDepth, min_split=5, min_leaf=2), label, seed=seed)


def gradient_boosting(label: str = LABEL, maxIter: int = 300, maxDepth: int = 8, seed: int = 42) -> Ensemble:
    return Ensemble("boosting", maxIter, Growth(maxDepth, min_split=5, min_leaf=2), label, rate=0.1, seed=seed)


def subsampled_boosting(label: str = LABEL, maxIter: int = 400, maxDepth: int = 10, seed: int = 42) -> Ensemble:
    """Second-order boosting: leaves are shrunk by a penalty of 1 and hold a curvature of 3 at least.

    Rows and columns are drawn once per step.
    """
    growth = Growth(maxDepth, min_weight=3.0, penalty=1.0)
    return Ensemble("boosting", maxIter, growth, label, rate=0.1, row_share=0.8, column_share=0.8, seed=seed)


_TREES = {"Random Forest": random_forest, "Gradient Boosting": gradient_boosting, "Subsampled Boosting": subsampled_boosting}


def estimators(sizes: Mapping[str, Mapping[str, int]] = SIZES, label: str = LABEL,
               seed: int = 42) -> dict[str, Linear | Ensemble]:
    """Model name to what to fit; ``fit`` takes a table with ``features`` and the label."""
    scaled = len(V.NUMERIC_FEATURES)
    found: dict[str, Linear | Ensemble] = {
        "Linear Regression": ols(label, scaled),
        "Ridge Regression": ridge(label, scaled=scaled),
        "Lasso Regression": lasso(label, scaled=scaled),
    }
    return found | {name: _TREES[name](label, **{**SIZES[name], **sizes.get(name, {})}, seed=seed) for name in SIZES}


def fit_regressor(train: DataFrame, estimator: Linear | Ensemble) -> PipelineModel:
    """Preprocessor and regressor as one persistable model."""
    pre = prep.fit_preprocessor(train)
    return PipelineModel(stages=[pre, estimator.fit(pre.transform(train).select("features", LABEL))])


def fold_r2(vectors: DataFrame, estimator: Linear | Ensemble, k: int = 5) -> DataFrame:
    """Mean and population deviation of R² over ``k`` folds of a table with ``listing_id``, ``features`` and the label.

    Linear models take one scan, ensembles grow the folds' models side by side. Codes and bins are those
    of the table; deviations that scale a penalty are those of the rows that a fold's model learns from.
    """
    if isinstance(estimator, Linear):
        scores = linear.fold_scores(linear.fold_moments(vectors, estimator.label, prep.fold(k)), estimator)
    else:
        found = fit_ensemble(vectors, estimator, F.xxhash64("listing_id"), None, prep.fold(k), k)[1]
        scores = found.loc[found["variant"] >= 0, "r2"].dropna().tolist()
    return _mean_and_deviation(vectors, scores)


def _mean_and_deviation(df: DataFrame, scores: Sequence[float]) -> DataFrame:
    row = (float(np.mean(scores)), float(np.std(scores))) if len(scores) else (None, None)
    return df.sparkSession.createDataFrame([row], "cv_mean double, cv_std double")


def kfold_r2(df: DataFrame, estimator: Linear | Ensemble, k: int = 5) -> DataFrame:
    """:func:`fold_r2` of engineered listings."""
    pre = prep.fit_preprocessor(df)
    return fold_r2(prep.feature_table(pre, df.select("listing_id", LABEL, *sum(V.feature_columns(), []))), estimator, k)


@dataclass
class PriceModels:
    models: dict[str, PipelineModel]
    metrics: DataFrame
    best: str
    predictions: DataFrame
    importances: dict[str, DataFrame]


def _feature_names() -> list[str]:
    numeric, categorical = V.feature_columns()
    return numeric + categorical


def train_regression(df: DataFrame, names: Sequence[str] | None = None,
                     sizes: Mapping[str, Mapping[str, int]] = SIZES, cv_folds: int = 5,
                     seed: int = 42) -> PriceModels:
    """Fit every model on the train split, score it on the test split, keep the best.

    The rows are prepared and stored once, with their side and fold. Linear models come from one scan
    of moments; an ensemble grows with its folds' models in the same jobs. The
    best model has the highest test R² on the log scale; the first wins a tie. Only
    numbers per model and boosted trees come to the driver.
    """
    spark = df.sparkSession
    numeric, categorical = V.feature_columns()
    rows_used = df.select("listing_id", "price", LABEL, *numeric, *categorical)
    pre = prep.fit_preprocessor(prep.split(rows_used, seed=seed)[0])
    is_train = prep.hash_share(seed) < 0.8
    vectors = stored(prep.feature_table(pre, rows_used).select(
        F.xxhash64("listing_id").alias("_key"), "features", "price", LABEL, is_train.alias("_train"), prep.fold(max(cv_folds, 1)).alias("_fold")), "vectors")
    specs = estimators(sizes, seed=seed)
    chosen = list(names or specs)
    moments = None
    rows, models, importances = [], {}, {}
    for name in chosen:
        spec = specs[name]
        if isinstance(spec, Linear):
            moments = moments or linear.fold_moments(vectors, LABEL, F.col("_fold"), F.col("_train"))
            seen = sum(m for (_, train), m in moments.items() if train)
            fitted = spec.model(seen)
            train_r2 = linear.r2(seen, fitted.coefficients, fitted.intercept)
            scores = linear.fold_scores(moments, spec) if cv_folds else []
        else:
            fitted, found = fit_ensemble(vectors, spec, F.col("_key"), F.col("_train"), F.col("_fold"), cv_folds)
            r2 = dict(zip(found["variant"], found["r2"]))
            train_r2, scores = r2.pop(-1), list(r2.values())
            importances[name] = evaluate.feature_importance(fitted, _feature_names(), spark)
        models[name] = PipelineModel(stages=[pre, fitted])
        scored = evaluate.prediction_table(fitted.transform(vectors.where(~F.col("_train"))), keep=())
        row = evaluate.regression_metrics(scored).first()
        values = {
            "train_r2": train_r2, "test_r2": row["r2_log"], "test_r2_original_scale": row["r2"],
            "rmse": row["rmse"], "mae": row["mae"], "mape": row["mape"],
        }
        if cv_folds:
            cv = _mean_and_deviation(df, scores).first()
            values |= {"cv_mean": cv["cv_mean"], "cv_std": cv["cv_std"]}
        rows += [("regression", name, metric, value) for metric, value in values.items()]
    discard(vectors)
    test_r2 = {model: value for _, model, metric, value in rows if metric == "test_r2"}
    best = max(test_r2, key=lambda m: float("-inf") if test_r2[m] is None else test_r2[m])
    predictions = evaluate.prediction_table(models[best].transform(prep.split(df, seed=seed)[1]))
    return PriceModels(models, spark.createDataFrame(rows, S.METRICS), best, predictions, importances)


def predict_price(df: DataFrame, model: Transformer) -> DataFrame:
    """Adds ``predicted_price``, back on the original scale and never below zero."""
    scored = model.transform(df)
    price = F.when(F.expm1("prediction") < 0, 0.0).otherwise(F.expm1("prediction"))
    return scored.withColumn("predicted_price", price).select(*df.columns, "predicted_price")
