"""Metrics of predictions, each from one aggregation of the prediction table."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forecourt.functions.numeric import at_least, ratio


def prediction_table(df: DataFrame, actual: str = "price", predicted_log: str = "prediction",
                     keep: Sequence[str] = ("listing_id",)) -> DataFrame:
    """Actual and predicted values on both scales; predictions never fall below zero."""
    log = F.col(predicted_log)
    return df.select(
        *keep, F.col(actual).cast("double").alias("actual"),
        at_least(F.expm1(log), 0.0).alias("predicted"),
        F.log1p(actual).alias("actual_log"), log.cast("double").alias("predicted_log"),
    )


def _r2(y: str, p: str) -> Column:
    error = F.sum(F.pow(F.col(y) - F.col(p), F.lit(2)))
    return F.lit(1.0) - F.try_divide(error, F.var_pop(y) * F.count(y))


def _mape(y: str, p: str) -> Column:
    guarded = F.when(F.col(y) != 0, F.col(y))
    return 100 * F.avg(F.abs((F.col(y) - F.col(p)) / guarded))


def regression_metrics(pred: DataFrame) -> DataFrame:
    """R² on both scales, RMSE, MAE and MAPE on the original one."""
    error = F.col("actual") - F.col("predicted")
    return pred.agg(
        _r2("actual_log", "predicted_log").alias("r2_log"), _r2("actual", "predicted").alias("r2"),
        F.sqrt(F.avg(error * error)).alias("rmse"), F.avg(F.abs(error)).alias("mae"),
        _mape("actual", "predicted").alias("mape"),
    )


def r2(pred: DataFrame, y: str = "actual_log", p: str = "predicted_log") -> DataFrame:
    return pred.agg(_r2(y, p).alias("r2"))


def mape(pred: DataFrame) -> DataFrame:
    """Mean absolute error in percent, over rows whose actual value is not zero."""
    return pred.agg(_mape("actual", "predicted").alias("mape"))


def residuals(pred: DataFrame) -> DataFrame:
    return pred.withColumn("residual", F.col("actual") - F.col("predicted"))


def prediction_range(pred: DataFrame) -> DataFrame:
    """The range that holds both actual and predicted values."""
    return pred.agg(
        F.least(F.min("actual"), F.min("predicted")).alias("low"),
        F.greatest(F.max("actual"), F.max("predicted")).alias("high"),
    )


def _class_counts(pred: DataFrame) -> DataFrame:
    return pred.groupBy("actual", "predicted").agg(F.count(F.lit(1)).alias("count"))


def confusion_matrix(pred: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Counts for every (actual, predicted) pair of ``labels``, zeros included."""
    listed = F.array(*[F.lit(x) for x in labels])
    grid = (
        pred.sparkSession.range(1)
        .select(F.posexplode(listed).alias("row", "actual"))
        .select("*", F.posexplode(listed).alias("col", "predicted"))
    )
    return grid.join(_class_counts(pred), ["actual", "predicted"], "left").select(
        "row", "col", "actual", "predicted", F.coalesce("count", F.lit(0)).cast("bigint").alias("count")
    )


def _per_class(pred: DataFrame) -> DataFrame:
    counts, zero = F.col("count"), F.lit(0).cast("bigint")
    hit = F.when(F.col("actual") == F.col("predicted"), counts).otherwise(zero)
    side = lambda label, support, claimed, hits: F.struct(
        F.col(label).alias("label"), support.alias("support"), claimed.alias("claimed"), hits.alias("hits"))
    sides = _class_counts(pred).select(
        F.inline(F.array(side("actual", counts, zero, hit), side("predicted", zero, counts, zero))))
    totals = sides.groupBy("label").agg(*[F.sum(c).alias(c) for c in ("support", "claimed", "hits")])
    none = F.lit(0.0)
    scored = totals.select(
        "label", "support", "hits",
        F.coalesce(ratio(F.col("hits"), F.col("claimed")), none).alias("precision"),
        F.coalesce(ratio(F.col("hits"), F.col("support")), none).alias("recall"),
    )
    p, r = F.col("precision"), F.col("recall")
    return scored.withColumn("f1", F.coalesce(F.try_divide(2 * p * r, p + r), none))


def classification_report(pred: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class, then their plain and weighted means.

    ``pred`` is read once: a class counts for its own line and, with their weights, for both means.
    """
    names = ("precision", "recall", "f1")
    line = lambda kind, label, weight: F.struct(
        F.lit(kind).alias("kind"), label.alias("label"), weight.cast("double").alias("weight"))
    lines = _per_class(pred).withColumn("_line", F.explode(F.array(
        line(0, F.col("label"), F.lit(1)), line(1, F.lit("macro avg"), F.lit(1)),
        line(2, F.lit("weighted avg"), F.col("support")),
    )))
    weight = F.col("_line.weight")
    return (
        lines.groupBy("_line.kind", "_line.label")
        .agg(*[F.try_divide(F.sum(weight * F.col(c)), F.sum(weight)).alias(c) for c in names],
             F.sum("support").alias("support"))
        .select("label", *names, "support")
    )


def classification_scores(pred: DataFrame) -> DataFrame:
    """Accuracy and the support-weighted scores in one row."""
    return _per_class(pred).agg(
        F.try_divide(F.sum("hits").cast("double"), F.sum("support")).alias("accuracy"),
        *[
            F.try_divide(F.sum(F.col(c) * F.col("support")), F.sum("support")).alias(f"{c}_weighted")
            for c in ("f1", "precision", "recall")
        ],
    )


def compare_models(metrics: DataFrame, columns: Sequence[str], best_by: str,
                   order: Sequence[str]) -> DataFrame:
    """One row per model in the given order; the first of the best ones is marked.

    Where train and test R² are both present, their difference is added.
    """
    wide = metrics.groupBy("model").pivot("metric", list(columns)).agg(F.first("value"))
    position = F.array_position(F.array(*[F.lit(m) for m in order]), F.col("model"))
    ranked = wide.withColumn("position", position.cast("int"))
    first = Window.orderBy(F.desc_nulls_last(best_by), "position")
    ranked = ranked.withColumn("is_best", F.row_number().over(first) == 1)
    if {"train_r2", "test_r2"} <= set(columns):
        ranked = ranked.withColumn("overfit_gap", F.col("train_r2") - F.col("test_r2"))
    return ranked.orderBy("position")


def feature_importance(model, names: Sequence[str], spark, top_n: int | None = None) -> DataFrame:
    """Importances of a fitted tree ensemble by feature name, largest first."""
    listed = spark.createDataFrame(list(enumerate(names)), "number int, feature string")
    found = model.importances().withColumnRenamed("feature", "number")
    ranked = listed.join(F.broadcast(found), "number").select("feature", "importance").orderBy(F.desc("importance"), "feature")
    return ranked if top_n is None else ranked.limit(top_n)
