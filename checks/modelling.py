"""Preparation, evaluation, models, segments and anomalies.

Metrics are checked on a predictor that SQL can repeat: the train split's median per make.
Full ensembles and K-Means have no SQL and are registered without; small trees, steps and folds made by
the same code have. Every model runs with the operators' defaults: sizes, cross-validation, numbers
of clusters and starts.
"""

from dataclasses import replace

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from checks import base as B
from forecourt import schema as S
from forecourt import vocabulary as V
from forecourt.operators import anomaly as A
from forecourt.operators import classify as K
from forecourt.operators import evaluate as M
from forecourt.operators import grouping as G
from forecourt.operators import lloyd
from forecourt.operators import prep
from forecourt.operators import regress as L
from forecourt.operators import segment as U
from forecourt.operators import smoothing
from forecourt.operators.lookup import lookup_join
from forecourt.operators.quantiles import median
from forecourt.sources import sinks

#: Sizes for tests of what the models feed; no query uses them.
SMALL = {
    "Random Forest": {"numTrees": 20, "maxDepth": 5},
    "Gradient Boosting": {"maxIter": 5, "maxDepth": 4},
    "Subsampled Boosting": {"maxIter": 5, "maxDepth": 4},
    K.FOREST: {"numTrees": 20, "maxDepth": 5},
    K.BOOSTING: {"maxIter": 3, "maxDepth": 3},
}
CATEGORICAL = list(V.CATEGORICAL_FEATURES)
#: A column of many values and one where every row has its own.
WIDE = ["model", "listing_id"]
SEGMENT = list(V.SEGMENT_FEATURES)
#: What the models, the segments, the anomalies and the small trees read.
MODELLED = ["listing_id", "price", "log_price", *V.NUMERIC_FEATURES, *V.CATEGORICAL_FEATURES]
POINTS = ["listing_id", *SEGMENT]
SCORED = ["listing_id", *dict.fromkeys([*SEGMENT, *(c for c in S.ANOMALIES.names if c not in ("anomaly_score", "is_anomaly"))])]
GROWN = ["listing_id", "cylinders", "year", "condition_score", "mileage", "is_luxury", "log_price", "body_type"]
CENTERS = [[50000.0, 60000.0], [60000.0, 240000.0], [400000.0, 150000.0]]
#: Features whose products with the predictions are compared.
MOMENTS = ("year", "cylinders", "condition_score", "feature_count", "is_luxury", "log_mileage")
BODIES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


def eng(f, digits=6, keep=None):
    """A query over the engineered listings; over a stored copy of the columns ``keep`` if it scans them more than once."""
    if keep:
        return lambda s, d: B.rounded(f(B.kept(B.engineered, s, d, keep)), digits)
    return lambda s, d: B.rounded(f(B.engineered(s, d)), digits)


def median_predictions(e):
    """Test rows with the train split's median price of their make."""
    train, test = prep.split(e)
    scored = lookup_join(test, median(train, "price", "make", "guess"), "make", "inner")
    return M.prediction_table(scored.withColumn("prediction", F.log1p("guess")))


def mode_predictions(e):
    """Test rows with the train split's most frequent body type of their make."""
    train, test = prep.split(e)
    best = G.top_k_per_group(train, "make", "body_type", 1).select("make", F.col("body_type").alias("predicted"))
    return lookup_join(test, best, "make", "inner").select(
        "listing_id", F.col("body_type").alias("actual"), "predicted"
    )


def _parts(train, test):
    return train.select("listing_id", F.lit("train").alias("part")).unionByName(
        test.select("listing_id", F.lit("test").alias("part"))
    )


def _preprocessed(e):
    train, test = prep.split(e)
    model = prep.fit_preprocessor(train)
    names = sum(V.feature_columns(), [])
    values = vector_to_array("features")
    return model.transform(test).select(
        "listing_id", *[values[names.index(c)].alias(c) for c in ("year", "log_mileage", "is_luxury", "make", "color")]
    )


def _one_feature(e):
    return VectorAssembler(inputCols=["cylinders"], outputCol="features").transform(e)


def _ols(e):
    rows = _one_feature(e)
    fitted = L.ols().fit(rows)
    r2 = M.r2(fitted.transform(rows), "log_price", "prediction").first()[0]
    return e.sparkSession.createDataFrame(
        [(float(fitted.coefficients[0]), float(fitted.intercept), float(r2))], "slope double, intercept double, r2 double"
    )


def _ridge(e):
    rows = _one_feature(prep.standardize(e, ["cylinders"]).withColumn("cylinders", F.col("cylinders_z")))
    rows = rows.select("features", "log_price")
    fitted = L.ridge(alpha=5000.0).fit(rows)
    return e.sparkSession.createDataFrame(
        [(float(fitted.coefficients[0]), float(fitted.intercept))], "slope double, intercept double"
    )


def _trained(*names):
    def query(e):
        return L.train_regression(e, names).metrics.drop("task")
    return query


def _lasso(cross_validated):
    """The SQL of the metrics on the splits has no folds, so those of the folds are a query of their own."""
    def query(e):
        of_folds = F.col("metric").startswith("cv_")
        return _trained("Lasso Regression")(e).where(of_folds if cross_validated else ~of_folds)
    return query


def _boosted(name):
    def query(e):
        return L.train_regression(e, [name]).predictions
    return query




def _importance(e):
    return L.train_regression(e, ["Random Forest"]).importances["Random Forest"]


def _compared(e):
    """Three constant or per-group guesses compared as models."""
    pred = median_predictions(e)
    spark = e.sparkSession
    guesses = {
        "by_make": pred,
        "by_make_again": pred,
        "overall": pred.withColumn("predicted", F.lit(60000.0)).withColumn("predicted_log", F.log1p(F.lit(60000.0))),
    }
    rows = []
    for name, table in guesses.items():
        row = M.regression_metrics(table).first()
        rows += [(name, "test_r2", row["r2_log"]), (name, "mae", row["mae"]), (name, "train_r2", row["r2"])]
    metrics = spark.createDataFrame(rows, "model string, metric string, value double")
    return M.compare_models(metrics, ["train_r2", "test_r2", "mae"], "test_r2", list(guesses))


def _classified(name):
    def query(e):
        return K.train_classification(e, [name]).predictions[name]
    return query


def _probabilities(e):
    trained = K.train_classification(e, [K.FOREST])
    return K.class_probabilities(e, trained.models[K.FOREST])


def _labelled(e):
    scaled = prep.standardize(e, SEGMENT)
    return scaled.withColumn("cluster", F.col("is_luxury")), [f"{c}_z" for c in SEGMENT]


def _silhouette(e):
    rows, cols = _labelled(e)
    return U.silhouette(rows, cols)


def _euclidean(e):
    rows, cols = _labelled(e)
    return U.silhouette_euclidean(rows, cols)


def _lloyd_steps(e):
    """Two runs of two steps side by side; every center is the mean of the rows that were nearest to it."""
    points = e.select(F.array(F.col("price"), F.col("mileage").cast("double")).alias("x"))
    found = lloyd.lloyd(points, {"three": np.array(CENTERS), "two": np.array(CENTERS[:2])}, max_iter=2, tol=0.0)
    rows = [(run, i, *map(float, c)) for run, cs in found.items() for i, c in enumerate(cs)]
    return e.sparkSession.createDataFrame(rows, "run string, cluster int, price double, mileage double")


def _pca_pair(e):
    rows = U.pca_project(e, 2, ["cylinders", "price"])
    return rows.select("listing_id", F.abs("pc1").alias("pc1"), F.abs("pc2").alias("pc2"))


def _profiles(e):
    return U.cluster_profiles(e.withColumn("cluster", F.col("is_luxury")))


def fixed_scores(e):
    score = F.lit(12.3) - F.col("log_price")
    return e.withColumn("anomaly_score", score).withColumn("is_anomaly", score < 0)


def _kept_anomalies(fmt):
    def query(e):
        path = B.scratch(e.sparkSession)
        sinks.write_anomalies(A.anomaly_table(fixed_scores(e)), path, fmt)
        return sinks.read_anomalies(e.sparkSession, path, fmt)

    return query


def _kept_metrics(e):
    """Metrics of two models, written as one table, appended to, and read back."""
    path = B.scratch(e.sparkSession)
    for mode, name, pred in (("overwrite", "by make", median_predictions(e)), ("append", "itself", median_predictions(e).withColumn(
            "predicted", F.col("actual")).withColumn("predicted_log", F.col("actual_log")))):
        wide = M.regression_metrics(pred).withColumns({"task": F.lit("regression"), "model": F.lit(name)})
        sinks.write_metrics(wide.unpivot(["task", "model"], ["r2_log", "r2", "rmse", "mae", "mape"], "metric", "value"), path, mode)
    return sinks.read_metrics(e.sparkSession, path)


def _kept_model(e):
    """Predictions of a model that was saved and loaded again: the mean of the train split's label."""
    path = B.scratch(e.sparkSession)
    sinks.save_model(L.train_regression(e, ["Lasso Regression"]).models["Lasso Regression"], path)
    return L.predict_price(e, sinks.load_model(path)).select("listing_id", "predicted_price")


def _forest(e):
    return A.fit_isolation_forest(e, contamination=None).nodes


def _samples(e):
    drawn = A.tree_samples(e, e.count(), A.FEATURES, A.TREES, A.SAMPLE, 42, "listing_id")
    return drawn.select("tree", F.col("_key").alias("listing_id"), F.col("_rank").alias("rank"))


def partly_missing(df, column):
    """``column`` without its values where the year is divisible by three."""
    return df.withColumn(column, F.when(F.col("year") % 3 != 0, F.col(column)))


def _normal_equations(e):
    """Moments of the predictions with the features, which least squares makes those of the label."""
    train, _ = prep.split(e)
    scored = L.train_regression(e, ["Linear Regression"]).models["Linear Regression"].transform(train)
    products = [F.struct(F.lit(c).alias("feature"), (F.col("prediction") * F.col(c)).alias("p")) for c in MOMENTS]
    rows = scored.select(F.explode(F.array(*products)).alias("m")).select("m.*")
    return rows.groupBy("feature").agg(F.avg("p").alias("moment"))


def _stump(e):
    """One boosting step of depth one, taken in full, on a two-valued feature: the label's mean on either side."""
    rows = VectorAssembler(inputCols=["is_luxury"], outputCol="features").transform(e)
    spec = L.estimators({"Gradient Boosting": {"maxIter": 1, "maxDepth": 1}})["Gradient Boosting"]
    scored = replace(spec, rate=1.0).fit(rows).transform(rows)
    return scored.groupBy("is_luxury").agg(F.avg("prediction").alias("prediction"), F.count("*").alias("n"))


def _lasso_of_one(e):
    """A lasso that keeps its coefficient, with R² of every fold's own model."""
    rows = prep.standardize(e, ["cylinders"]).withColumn("cylinders", F.col("cylinders_z"))
    rows = _one_feature(rows).select("listing_id", "features", "log_price")
    spec = L.lasso(alpha=0.05)
    fitted = spec.fit(rows)
    slope = e.sparkSession.createDataFrame([(float(fitted.coefficients[0]), fitted.intercept)], "slope double, intercept double")
    return slope.crossJoin(L.fold_r2(rows, spec))


#: Features of the small trees: each value is common enough for a bin of its own.
SPLIT_ON = ("cylinders", "year", "condition_score", "mileage")


def _split_rows(e):
    return VectorAssembler(inputCols=list(SPLIT_ON), outputCol="features").transform(e)


def _small(spec):
    def query(e):
        rows = _split_rows(e)
        return spec.fit(rows).transform(rows).select("listing_id", "prediction")
    return query


def _class_step(e):
    """Probabilities after one step of boosting all classes together."""
    position = F.array_position(F.array(*[F.lit(b) for b in BODIES]), F.col("body_type")) - 1
    rows = _split_rows(e).withColumn("label", position.cast("double"))
    spec = replace(K.estimator(K.BOOSTING, {"maxIter": 1, "maxDepth": 2}), classes=len(BODIES))
    scored = spec.fit(rows).transform(rows)
    return scored.select("listing_id", *[F.col("probability")[i].alias(f"p{i}") for i in range(len(BODIES))])


def _scored(e):
    forest = A.fit_isolation_forest(e)
    return A.anomaly_table(A.score_isolation_forest(e, forest))


QUERIES = {
    "standardize": eng(lambda e: prep.standardize(e, SEGMENT).select("listing_id", *[f"{c}_z" for c in SEGMENT]), keep=POINTS),
    "ordinal_encode": eng(lambda e: prep.ordinal_encode(e, CATEGORICAL).select("listing_id", *[f"{c}_code" for c in CATEGORICAL]), keep=["listing_id", *CATEGORICAL]),
    "ordinal_encode_wide": eng(lambda e: prep.ordinal_encode(e, WIDE).select("listing_id", *[f"{c}_code" for c in WIDE]), keep=WIDE),
    "fit_preprocessor": eng(_preprocessed, keep=MODELLED),
    "split": eng(lambda e: _parts(*prep.split(e))),
    "stratified_split": eng(lambda e: _parts(*prep.stratified_split(e, "body_type"))),
    "kfold_r2": eng(lambda e: L.kfold_r2(e, L.lasso()), keep=MODELLED),
    "kfold_r2_linear": eng(lambda e: L.fold_r2(_one_feature(e), L.ols()), keep=GROWN),
    "lasso_one_feature": eng(_lasso_of_one, keep=GROWN),
    "forest_tree": eng(_small(replace(L.random_forest(numTrees=1, maxDepth=2), bootstrap=False)), keep=GROWN),
    "boosting_steps": eng(_small(L.gradient_boosting(maxIter=3, maxDepth=2)), keep=GROWN),
    "second_order_tree": eng(_small(replace(L.subsampled_boosting(maxIter=1, maxDepth=2), row_share=1.0, column_share=1.0)), keep=GROWN),
    "class_boosting_step": eng(_class_step, keep=GROWN),
    "prediction_table": eng(median_predictions),
    "regression_metrics": eng(lambda e: M.regression_metrics(median_predictions(e))),
    "mape": eng(lambda e: M.mape(median_predictions(e))),
    "residuals": eng(lambda e: M.residuals(median_predictions(e)).select("listing_id", "residual")),
    "prediction_range": eng(lambda e: M.prediction_range(median_predictions(e))),
    "confusion_matrix": eng(lambda e: M.confusion_matrix(mode_predictions(e), BODIES)),
    "classification_report": eng(lambda e: M.classification_report(mode_predictions(e))),
    "classification_scores": eng(lambda e: M.classification_scores(mode_predictions(e))),
    "compare_models": eng(_compared),
    "feature_importance": eng(_importance, keep=MODELLED),
    "linear_regression": eng(_ols, keep=GROWN),
    "linear_regression_moments": eng(_normal_equations, 3, keep=MODELLED),
    "boosting_stump": eng(_stump, keep=GROWN),
    "ridge_regression": eng(_ridge, keep=GROWN),
    "lasso_regression": eng(_lasso(False), keep=MODELLED),
    "lasso_regression_cv": eng(_lasso(True), keep=MODELLED),
    "train_linear_models": eng(_trained("Linear Regression", "Ridge Regression"), keep=MODELLED),
    "random_forest_regression": eng(_boosted("Random Forest"), keep=MODELLED),
    "gradient_boosting_regression": eng(_boosted("Gradient Boosting"), keep=MODELLED),
    "subsampled_boosting_regression": eng(_boosted("Subsampled Boosting"), keep=MODELLED),
    "restrict_classes": eng(lambda e: K.restrict_classes(e, 4).select("listing_id", "body_type")),
    "random_forest_classifier": eng(_classified(K.FOREST), keep=MODELLED),
    "gradient_boosting_classifier": eng(_classified(K.BOOSTING), keep=MODELLED),
    "class_probabilities": eng(_probabilities, keep=MODELLED),
    "kmeans_sweep": eng(lambda e: U.kmeans_sweep(e).sweep, keep=POINTS),
    "kmeans_steps": eng(_lloyd_steps, 3, keep=POINTS),
    "silhouette": eng(_silhouette, keep=POINTS),
    "silhouette_euclidean": eng(_euclidean, keep=POINTS),
    "assign_cluster": eng(lambda e: U.assign_cluster(e, ["price", "mileage"], CENTERS).select("listing_id", "cluster")),
    "assign_cluster_missing": eng(lambda e: U.assign_cluster(
        partly_missing(e, "mileage"), ["price", "mileage"], CENTERS).select("listing_id", "cluster")),
    "pca_project_pair": eng(_pca_pair, keep=POINTS),
    "pca_project": eng(lambda e: U.pca_project(e).select("listing_id", "pc1", "pc2"), keep=POINTS),
    "cluster_profiles": eng(_profiles),
    "name_segments": eng(lambda e: U.name_segments(_profiles(e)).select("cluster", "segment_name")),
    "name_segments_larger": eng(lambda e: U.name_segments(_profiles(e), "larger").select("cluster", "segment_name")),
    "isolation_samples": eng(_samples, keep=POINTS),
    "fit_isolation_forest": eng(_forest, keep=POINTS),
    "score_isolation_forest": eng(_scored, keep=SCORED),
    "anomaly_summary": eng(lambda e: A.anomaly_summary(fixed_scores(e))),
    "top_anomalies": eng(lambda e: A.top_anomalies(fixed_scores(e)).select("rank", "listing_id", "price", "anomaly_score")),
    "write_anomalies": eng(_kept_anomalies("parquet")),
    "write_anomalies_csv": eng(_kept_anomalies("csv")),
    "write_metrics": eng(_kept_metrics),
    "save_model": eng(_kept_model, keep=MODELLED),
    "local_regression_plain": eng(lambda e: smoothing.local_regression(e, "year", "price", iters=0), 4),
    "local_regression_many": eng(lambda e: smoothing.local_regression(e, "mileage_per_year", "price", iters=0), 4),
    "local_regression": eng(lambda e: smoothing.local_regression(e, "mileage_per_year", "price")),
}

SHARE = "CAST(concat('0x', substr(md5(concat('42|', listing_id)), 1, 8)) AS BIGINT) / 4294967296.0"
_FOLD = "CAST(floor(5 * CAST(concat('0x', substr(md5(concat('7|', listing_id)), 1, 8)) AS BIGINT) / 4294967296.0) AS INT)"
_SPLIT = f", parts AS (SELECT *, {SHARE} AS share, {SHARE} < 0.8 AS is_train FROM eng)"
_PRED = _SPLIT + """, guess AS (SELECT make, quantile_cont(price, 0.5) AS g FROM parts WHERE is_train GROUP BY make),
logged AS (SELECT p.*, ln(1 + g) AS predicted_log FROM parts p JOIN guess USING (make) WHERE NOT is_train),
pred AS (SELECT listing_id, price AS actual, greatest(exp(predicted_log) - 1, 0) AS predicted, log_price AS actual_log, predicted_log FROM logged)"""
_METRICS = """(1 - sum((actual_log - predicted_log) ** 2) / (var_pop(actual_log) * count(*))) AS r2_log,
 (1 - sum((actual - predicted) ** 2) / (var_pop(actual) * count(*))) AS r2, sqrt(avg((actual - predicted) ** 2)) AS rmse,
 avg(abs(actual - predicted)) AS mae, 100 * avg(abs((actual - predicted) / actual)) FILTER (WHERE actual != 0) AS mape"""
_CLASSES = _SPLIT + """, ranked AS (SELECT make, body_type, row_number() OVER (PARTITION BY make ORDER BY count(*) DESC, body_type) AS r
 FROM parts WHERE is_train GROUP BY make, body_type),
pred AS (SELECT listing_id, p.body_type AS actual, ranked.body_type AS predicted FROM parts p JOIN ranked ON p.make = ranked.make AND r = 1 WHERE NOT is_train)"""
_PER_CLASS = _CLASSES + """, labels AS (SELECT actual AS label FROM pred UNION SELECT predicted FROM pred),
counted AS (SELECT label, (SELECT count(*) FROM pred WHERE actual = label) AS support,
 (SELECT count(*) FROM pred WHERE predicted = label) AS claimed,
 (SELECT count(*) FROM pred WHERE actual = label AND predicted = label) AS hits FROM labels),
scored AS (SELECT label, support, hits, coalesce(hits / nullif(claimed, 0), 0) AS precision, coalesce(hits / nullif(support, 0), 0) AS recall FROM counted),
report AS (SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1 FROM scored)"""


def _z(c, table="eng"):
    return f"(({c} - (SELECT avg({c}) FROM {table})) / (SELECT stddev_pop({c}) FROM {table}))"


def _code(c):
    return f"CAST(dense_rank() OVER (ORDER BY {c}) - 1 AS DOUBLE) AS {c}_code"


_TRAIN = ", train AS (SELECT * FROM parts WHERE is_train)"
_FOLDS = f""", f AS (SELECT log_price AS y, {_FOLD} AS fold FROM eng),
m AS (SELECT k.fold, (SELECT avg(y) FROM f WHERE f.fold != k.fold) AS guess FROM (SELECT DISTINCT fold FROM f) k),
r AS (SELECT 1 - sum((y - guess) ** 2) / (var_pop(y) * count(*)) AS r2 FROM f JOIN m USING (fold) GROUP BY fold)"""

_LABELLED = ", z AS (SELECT is_luxury AS cluster, " + ", ".join(f"{_z(c)} AS z{i}" for i, c in enumerate(SEGMENT)) + " FROM eng)"
_NORM = " + ".join(f"z{i} * z{i}" for i in range(5))
_SILHOUETTE = _LABELLED + f""", c AS (SELECT cluster, count(*) AS n, avg({_NORM}) AS q, """ + ", ".join(
    f"avg(z{i}) AS m{i}" for i in range(5)) + f""" FROM z GROUP BY cluster),
d AS (SELECT z.cluster AS own, c.cluster AS other, c.n, {_NORM} - 2 * ({' + '.join(f'z{i} * m{i}' for i in range(5))}) + q AS dist,
 row_number() OVER () AS pair, z.* FROM z, c)
SELECT round(avg(CASE WHEN greatest(a, b) > 0 THEN (b - a) / greatest(a, b) ELSE 0 END), 6) AS silhouette FROM (
 SELECT s.own_dist * s.n / (s.n - 1) AS a, s.other_dist AS b FROM (
  SELECT e0.dist AS own_dist, e1.dist AS other_dist, e0.n FROM
   (SELECT *, row_number() OVER (PARTITION BY own ORDER BY z0, z1, z2, z3, z4) AS r FROM d WHERE own = other) e0
   JOIN (SELECT *, row_number() OVER (PARTITION BY own ORDER BY z0, z1, z2, z3, z4) AS r FROM d WHERE own != other) e1
   ON e0.own = e1.own AND e0.r = e1.r) s)"""
_APART = "sqrt(" + " + ".join(f"(z.z{i} - s.z{i}) * (z.z{i} - s.z{i})" for i in range(5)) + ")"
_EUCLIDEAN = _LABELLED.replace("SELECT is_luxury", "SELECT CAST(row_number() OVER () AS INT) AS r, is_luxury") + f""",
n AS (SELECT cluster, count(*) AS n FROM z GROUP BY cluster),
d AS (SELECT z.r, any_value(z.cluster) AS own, sum({_APART}) FILTER (WHERE s.cluster = 0) AS d0, sum({_APART}) FILTER (WHERE s.cluster = 1) AS d1
 FROM z, z s GROUP BY z.r),
e AS (SELECT r, own = cluster AS own, CASE cluster WHEN 0 THEN d0 ELSE d1 END / (n - CAST(own = cluster AS INT)) AS dist FROM d, n),
t AS (SELECT r, min(dist) FILTER (WHERE own) AS a, min(dist) FILTER (WHERE NOT own) AS b FROM e GROUP BY r)
SELECT round(avg(CASE WHEN greatest(a, b) > 0 THEN (b - a) / greatest(a, b) ELSE 0 END), 6) AS silhouette,
 0.0::DOUBLE AS error, count(*) AS scored FROM t"""
_KEPT = " SELECT " + ", ".join(f"round({f.name}, 6) AS {f.name}" if f.dataType.simpleString() == "double" else f.name for f in S.ANOMALIES) + " FROM s"
_DIST = ", ".join(
    f"(price - {p}) ** 2 + (mileage - {m}) ** 2 AS d{i}" for i, (p, m) in enumerate(CENTERS))


def _chance(seed, *parts):
    """SQL of a number in (0, 1) fixed by a seed and values."""
    values = ", '|', ".join(parts)
    return f"(CAST(concat('0x', substr(md5(concat('{seed}|', {values})), 1, 8)) AS BIGINT) + 0.5) / 4294967296.0"


def _gap(j):
    return f"CAST(floor(ln({_chance(43, j, 'listing_id')}) / ln(1 - p)) AS BIGINT)"


_SAMPLED = f""", n AS (SELECT 2.0 * {A.SAMPLE} / count(*) AS p FROM eng),
walk AS (SELECT listing_id, p, 0 AS j, {_gap('0')} AS t FROM eng, n
 UNION ALL SELECT listing_id, p, j + 1, t + 1 + {_gap('j + 1')} FROM walk WHERE t < {A.TREES}),
ranked AS (SELECT t, listing_id, row_number() OVER (PARTITION BY t ORDER BY {_chance(44, 't', 'listing_id')}, listing_id) AS r FROM walk WHERE t < {A.TREES})
SELECT CAST(t AS INT) AS tree, listing_id, CAST(r AS INT) AS rank FROM ranked WHERE r <= {A.SAMPLE}"""


def _nearest(n, of):
    """SQL of one Lloyd step: the mean of the rows nearest to each of ``n`` centers of the table ``of``."""
    return (f"SELECT c.i, avg(e.price) AS p, avg(e.mileage) AS m FROM (SELECT price, mileage, (SELECT arg_min(i, (price - p) ** 2 + (mileage - m) ** 2) "
            f"FROM {of}) AS i FROM eng) e RIGHT JOIN {of} c USING (i) WHERE c.i < {n} GROUP BY c.i")


def _two_steps(name, n):
    values = ", ".join(f"({i}, {p}::DOUBLE, {m}::DOUBLE)" for i, (p, m) in enumerate(CENTERS[:n]))
    return (f"{name}0 AS (SELECT * FROM (VALUES {values}) t(i, p, m)), {name}1 AS MATERIALIZED ({_nearest(n, name + '0')}), "
            f"{name}2 AS MATERIALIZED ({_nearest(n, name + '1')})")


_LLOYD = ", " + _two_steps("three", 3) + ", " + _two_steps("two", 2) + " " + " UNION ALL ".join(
    f"SELECT '{r}' AS run, CAST(i AS INT) AS cluster, round(p, 3) AS price, round(m, 3) AS mileage FROM {r}2" for r in ("three", "two"))
_PROFILE = """p AS (SELECT is_luxury AS cluster, count(*) AS count, round_even(avg(price), 0) AS avg_price,
 round_even(avg(mileage), 0) AS avg_mileage, round_even(avg(car_age) * 10, 0) / 10 AS avg_car_age,
 round_even(avg(cylinders) * 10, 0) / 10 AS avg_cylinders, round_even(100 * avg(is_luxury) * 10, 0) / 10 AS luxury_pct FROM eng GROUP BY 1)"""
_FIXED = ", s AS (SELECT *, 12.3 - log_price AS anomaly_score, 12.3 - log_price < 0 AS is_anomaly FROM eng)"

def _lowess(x):
    """LOWESS without robustness at the quantiles of ``x``, over counts and sums per distinct value."""
    return f""", c AS (SELECT CAST({x} AS DOUBLE) AS x, count(*) AS n, sum(price) AS sy FROM eng GROUP BY 1),
s AS (SELECT list(CAST({x} AS DOUBLE) ORDER BY {x}) AS v, count(*) AS total FROM eng),
p AS (SELECT v, CAST(i AS DOUBLE) / {smoothing.NODES - 1} * (total - 1) AS pos FROM s, range({smoothing.NODES}) r(i)),
q AS (SELECT DISTINCT v[CAST(floor(pos) AS INT) + 1] + (v[CAST(ceil(pos) AS INT) + 1] - v[CAST(floor(pos) AS INT) + 1]) * (pos - floor(pos)) AS x0 FROM p),
d AS (SELECT x0, n, sy, x - x0 AS t, abs(x - x0) AS d, sum(n) OVER (PARTITION BY x0 ORDER BY abs(x - x0), x) AS cum FROM q, c),
h AS (SELECT x0, min(d) AS h FROM d WHERE cum >= (SELECT floor(count(*) * 2 / 3.0) FROM eng) GROUP BY x0),
k AS (SELECT d.*, CASE WHEN d <= 0.001 * h THEN 1 WHEN d >= 0.999 * h THEN 0 ELSE (1 - (d / h) ** 3) ** 3 END AS w FROM d JOIN h USING (x0)),
m AS (SELECT x0, sum(n) FILTER (WHERE w > 0) AS n, sum(w * n * t) / sum(w * n) AS mt, sum(w * sy) / sum(w * n) AS my FROM k GROUP BY x0),
l AS (SELECT x0, sum(w * k.n * (t - mt) ** 2) AS stt, sum(w * (t - mt) * (sy - k.n * my)) AS sty FROM k JOIN m USING (x0) GROUP BY x0)
SELECT round(x0, 4) AS x, round(my - sty / stt * mt, 4) AS fitted, CAST(n AS BIGINT) AS n FROM l JOIN m USING (x0)"""


def _grown(name, rows, min_leaf=2, penalty=0, min_split=5):
    """SQL of a tree of depth two over ``rows`` (listing_id, the features, g): ``name``2 has every row's node."""
    features = " UNION ALL ".join(
        f"SELECT node, {i} AS f, CAST({c} AS DOUBLE) AS v, g FROM {{0}}" for i, c in enumerate(SPLIT_ON))
    value = "CASE b.f " + " ".join(f"WHEN {i} THEN r.{c}" for i, c in enumerate(SPLIT_ON)) + " END"
    sql, last = f"{name}0 AS MATERIALIZED (SELECT *, 1 AS node FROM {rows})", f"{name}0"
    for depth in (1, 2):
        sql += f""", {name}c{depth} AS (SELECT node, f, v, count(*) AS n, sum(g) AS s FROM ({features.format(last)}) GROUP BY ALL),
{name}w{depth} AS (SELECT node, f, v, sum(n) OVER up AS nl, sum(s) OVER up AS sl, sum(n) OVER (PARTITION BY node, f) AS n, sum(s) OVER (PARTITION BY node, f) AS s
 FROM {name}c{depth} WINDOW up AS (PARTITION BY node, f ORDER BY v)),
{name}g{depth} AS (SELECT *, sl * sl / (nl + {penalty}) + (s - sl) * (s - sl) / (n - nl + {penalty}) - s * s / (n + {penalty}) AS gain
 FROM {name}w{depth} WHERE nl >= {min_leaf} AND n - nl >= {min_leaf} AND n >= {min_split}),
{name}b{depth} AS MATERIALIZED (SELECT * FROM {name}g{depth} WHERE gain > 1e-9 QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, v) = 1),
{name}{depth} AS MATERIALIZED (SELECT r.* EXCLUDE (node), CASE WHEN b.node IS NULL THEN r.node WHEN {value} > b.v THEN 2 * r.node + 1 ELSE 2 * r.node END AS node
 FROM {last} r LEFT JOIN {name}b{depth} b ON r.node = b.node)"""
        last = f"{name}{depth}"
    return sql


_ROWS = f"eng_rows AS MATERIALIZED (SELECT listing_id, {', '.join(SPLIT_ON)}, log_price AS y, body_type FROM eng)"
_FOREST_TREE = (f", {_ROWS}, t AS (SELECT *, y AS g FROM eng_rows), {_grown('a', 't')} "
                "SELECT listing_id, round(avg(g) OVER (PARTITION BY node), 6) AS prediction FROM a2")


def _steps(n, rate, penalty=0, **limits):
    sql, last = f", {_ROWS}, p0 AS (SELECT *, avg(y) OVER () AS p FROM eng_rows)", "p0"
    for k in range(n):
        leaf = f"sum(g) OVER (PARTITION BY node) / (count(*) OVER (PARTITION BY node) + {penalty})"
        sql += (f", r{k} AS (SELECT *, y - p AS g FROM {last}), {_grown(f's{k}_', f'r{k}', penalty=penalty, **limits)}, "
                f"p{k + 1} AS MATERIALIZED (SELECT * EXCLUDE (g, node, p), p + {rate} * {leaf} AS p FROM s{k}_2)")
        last = f"p{k + 1}"
    return sql + f" SELECT listing_id, round(p, 6) AS prediction FROM {last}"


def _class_sql():
    n = len(BODIES)
    sql = f", {_ROWS}"
    for k, body in enumerate(BODIES):
        prior = f"(SELECT avg(CAST(body_type = '{body}' AS INT)) FROM eng)"
        sql += f""", q{k} AS (SELECT * EXCLUDE (g0), g0 - {prior} AS g FROM (SELECT *, CAST(body_type = '{body}' AS INT) AS g0 FROM eng_rows)),
{_grown(f'k{k}_', f'q{k}', min_leaf=1, min_split=2)},
m{k} AS (SELECT listing_id, ln({prior}) + 0.1 * {n - 1} / {n} * sum(g) OVER (PARTITION BY node) / sum(abs(g) * (1 - abs(g))) OVER (PARTITION BY node) AS m FROM k{k}_2)"""
    joined = "m0 " + " ".join(f"JOIN m{k} USING (listing_id)" for k in range(1, n))
    total = " + ".join(f"exp(m{k}.m)" for k in range(n))
    shares = ", ".join(f"exp(m{k}.m) / ({total}) AS x{k}" for k in range(n))
    return sql + f", s AS (SELECT listing_id, {shares} FROM {joined}) SELECT listing_id, " + ", ".join(
        f"round(x{k}, 6) AS p{k}" for k in range(n)) + " FROM s"


_LINEAR_FOLDS = f""", f AS (SELECT {{x}} AS x, log_price AS y, {_FOLD} AS fold FROM eng),
w AS (SELECT k.fold, (SELECT {{slope}} FROM f WHERE f.fold != k.fold) AS b, (SELECT avg(x) FROM f WHERE f.fold != k.fold) AS mx,
 (SELECT avg(y) FROM f WHERE f.fold != k.fold) AS my FROM (SELECT DISTINCT fold FROM f) k),
r AS (SELECT 1 - sum((y - my - b * (x - mx)) ** 2) / (var_pop(y) * count(*)) AS r2 FROM f JOIN w USING (fold) GROUP BY fold)"""
_SHRUNK = "sign(covar_pop(y, x)) * greatest(abs(covar_pop(y, x)) - 0.05, 0) / var_pop(x)"

ORACLES = {
    "kfold_r2_linear": B.over_engineered(_LINEAR_FOLDS.format(x="cylinders", slope="regr_slope(y, x)")
        + " SELECT round(avg(r2), 6) AS cv_mean, round(stddev_pop(r2), 6) AS cv_std FROM r"),
    "lasso_one_feature": B.over_engineered(_LINEAR_FOLDS.format(x=_z("cylinders"), slope=_SHRUNK)
        + f", o AS (SELECT {_SHRUNK} AS b, avg(x) AS mx, avg(y) AS my FROM f) SELECT round(any_value(b), 6) AS slope, round(any_value(my - b * mx), 6) AS intercept, "
        "round(avg(r2), 6) AS cv_mean, round(stddev_pop(r2), 6) AS cv_std FROM o, r"),
    "forest_tree": B.over_engineered(_FOREST_TREE),
    "boosting_steps": B.over_engineered(_steps(3, 0.1)),
    "second_order_tree": B.over_engineered(_steps(1, 0.1, penalty=1, min_leaf=3, min_split=2)),
    "class_boosting_step": B.over_engineered(_class_sql()),
    "standardize": B.over_engineered("SELECT listing_id, " + ", ".join(
        f"round({_z(c)}, 6) AS {c}_z" for c in SEGMENT) + " FROM eng"),
    "ordinal_encode_wide": B.over_engineered("SELECT listing_id, " + ", ".join(map(_code, WIDE)) + " FROM eng"),
    "ordinal_encode": B.over_engineered("SELECT listing_id, " + ", ".join(map(_code, CATEGORICAL)) + " FROM eng"),
    "fit_preprocessor": B.over_engineered(_SPLIT + _TRAIN + ", codes AS (SELECT DISTINCT make, dense_rank() OVER (ORDER BY make) - 1 AS m FROM train), "
        "colors AS (SELECT DISTINCT color, dense_rank() OVER (ORDER BY color) - 1 AS k FROM train) SELECT listing_id, "
        + ", ".join(f"round({_z(c, 'train')}, 6) AS {c}" for c in ("year", "log_mileage", "is_luxury"))
        + ", CAST(coalesce(m, -1) AS DOUBLE) AS make, CAST(coalesce(k, -1) AS DOUBLE) AS color FROM parts "
        "LEFT JOIN codes USING (make) LEFT JOIN colors USING (color) WHERE NOT is_train"),
    "split": B.over_engineered(_SPLIT + "SELECT listing_id, CASE WHEN is_train THEN 'train' ELSE 'test' END AS part FROM parts"),
    "stratified_split": B.over_engineered(_SPLIT + ", b AS (SELECT body_type, quantile_cont(share, 0.8) AS border FROM parts GROUP BY 1) "
        "SELECT listing_id, CASE WHEN share <= border THEN 'train' ELSE 'test' END AS part FROM parts JOIN b USING (body_type)"),
    "kfold_r2": B.over_engineered(_FOLDS + " SELECT round(avg(r2), 6) AS cv_mean, round(stddev_pop(r2), 6) AS cv_std FROM r"),
    "prediction_table": B.over_engineered(_PRED + " SELECT listing_id, " + ", ".join(
        f"round({c}, 6) AS {c}" for c in ("actual", "predicted", "actual_log", "predicted_log")) + " FROM pred"),
    "regression_metrics": B.over_engineered(_PRED + f", m AS (SELECT {_METRICS} FROM pred) SELECT " + ", ".join(
        f"round({c}, 6) AS {c}" for c in ("r2_log", "r2", "rmse", "mae", "mape")) + " FROM m"),
    "mape": B.over_engineered(_PRED + f", m AS (SELECT {_METRICS} FROM pred) SELECT round(mape, 6) AS mape FROM m"),
    "residuals": B.over_engineered(_PRED + " SELECT listing_id, round(actual - predicted, 6) AS residual FROM pred"),
    "prediction_range": B.over_engineered(_PRED + " SELECT round(least(min(actual), min(predicted)), 6) AS low, "
        "round(greatest(max(actual), max(predicted)), 6) AS high FROM pred"),
    "confusion_matrix": B.over_engineered(_CLASSES + ", l AS (SELECT * FROM (VALUES " + ", ".join(
        f"({i}, '{b}')" for i, b in enumerate(BODIES)) + ") AS t(i, label)) SELECT a.i AS row, p.i AS col, a.label AS actual, p.label AS predicted, "
        "(SELECT count(*) FROM pred WHERE pred.actual = a.label AND pred.predicted = p.label) AS count FROM l a, l p"),
    "classification_report": B.over_engineered(_PER_CLASS + ", u AS (SELECT label, precision, recall, f1, support FROM report "
        "UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), CAST(sum(support) AS BIGINT) FROM report "
        "UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support), "
        "sum(f1 * support) / sum(support), CAST(sum(support) AS BIGINT) FROM report) "
        "SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM u"),
    "classification_scores": B.over_engineered(_PER_CLASS + " SELECT round(sum(hits) / sum(support), 6) AS accuracy, "
        "round(sum(f1 * support) / sum(support), 6) AS f1_weighted, round(sum(precision * support) / sum(support), 6) AS precision_weighted, "
        "round(sum(recall * support) / sum(support), 6) AS recall_weighted FROM report"),
    "compare_models": B.over_engineered(_PRED + f""", a AS (SELECT {_METRICS} FROM pred),
 o AS (SELECT {_METRICS} FROM (SELECT actual, actual_log, 60000.0::DOUBLE AS predicted, ln(60001) AS predicted_log FROM pred)),
 t AS (SELECT 'by_make' AS model, 1 AS position, * FROM a UNION ALL SELECT 'by_make_again', 2, * FROM a UNION ALL SELECT 'overall', 3, * FROM o)
 SELECT model, position, round(r2, 6) AS train_r2, round(r2_log, 6) AS test_r2, round(mae, 6) AS mae,
 row_number() OVER (ORDER BY r2_log DESC, position) = 1 AS is_best, round(r2 - r2_log, 6) AS overfit_gap FROM t"""),
    "linear_regression": B.over_engineered("SELECT round(regr_slope(log_price, cylinders), 6) AS slope, "
        "round(regr_intercept(log_price, cylinders), 6) AS intercept, round(regr_r2(log_price, cylinders), 6) AS r2 FROM eng"),
    "ridge_regression": B.over_engineered(f", t AS (SELECT {_z('cylinders')} AS z, log_price AS y FROM eng) "
        "SELECT round(regr_sxy(y, z) / (regr_sxx(y, z) + 5000), 6) AS slope, round(avg(y), 6) AS intercept FROM t"),
    "lasso_regression": B.over_engineered(_SPLIT + ", g AS (SELECT avg(log_price) AS guess FROM parts WHERE is_train), "
        "pred AS (SELECT price AS actual, greatest(exp(guess) - 1, 0) AS predicted, log_price AS actual_log, guess AS predicted_log FROM parts, g WHERE NOT is_train), "
        f"m AS (SELECT {_METRICS} FROM pred), t AS (SELECT 1 - sum((log_price - guess) ** 2) / (var_pop(log_price) * count(*)) AS r FROM parts, g WHERE is_train) "
        + " UNION ALL ".join(
            f"SELECT 'Lasso Regression' AS model, '{n}' AS metric, round({c}, 6) AS value FROM {t}"
            for n, c, t in (("train_r2", "r", "t"), ("test_r2", "r2_log", "m"), ("test_r2_original_scale", "r2", "m"),
                            ("rmse", "rmse", "m"), ("mae", "mae", "m"), ("mape", "mape", "m")))),
    "lasso_regression_cv": B.over_engineered(_FOLDS + " SELECT 'Lasso Regression' AS model, 'cv_mean' AS metric, round(avg(r2), 6) AS value FROM r "
        "UNION ALL SELECT 'Lasso Regression', 'cv_std', round(stddev_pop(r2), 6) FROM r"),
    "restrict_classes": B.over_engineered("SELECT listing_id, body_type FROM eng WHERE body_type IN (SELECT body_type FROM eng GROUP BY 1 "
        "ORDER BY count(*) DESC, body_type LIMIT 4)"),
    "kmeans_steps": B.over_engineered(_LLOYD),
    "isolation_samples": B.over_engineered(_SAMPLED).replace("WITH", "WITH RECURSIVE", 1),
    "silhouette": B.over_engineered(_SILHOUETTE),
    "silhouette_euclidean": B.over_engineered(_EUCLIDEAN),
    "assign_cluster": B.over_engineered(f", t AS (SELECT listing_id, {_DIST} FROM eng) SELECT listing_id, "
        "CAST(CASE WHEN d0 <= d1 AND d0 <= d2 THEN 0 WHEN d1 <= d2 THEN 1 ELSE 2 END AS INT) AS cluster FROM t"),
    "pca_project_pair": B.over_engineered(f"SELECT listing_id, round(abs({_z('cylinders')} + {_z('price')}) / sqrt(2), 6) AS pc1, "
        f"round(abs({_z('cylinders')} - {_z('price')}) / sqrt(2), 6) AS pc2 FROM eng"),
    "cluster_profiles": B.over_engineered(f", {_PROFILE} SELECT * FROM p"),
    "name_segments": B.over_engineered(f", {_PROFILE} SELECT cluster, CASE WHEN luxury_pct > 50 THEN 'Luxury Segment' ELSE 'Mass Market Segment' END AS segment_name FROM p"),
    "name_segments_larger": B.over_engineered(f", {_PROFILE} SELECT cluster, CASE WHEN luxury_pct = (SELECT max(luxury_pct) FROM p) "
        "THEN 'Luxury Segment' ELSE 'Mass Market Segment' END AS segment_name FROM p"),
    "anomaly_summary": B.over_engineered(_FIXED + " SELECT count(*) FILTER (WHERE is_anomaly) AS n_anomalies, "
        "count(*) FILTER (WHERE NOT is_anomaly) AS n_normal, "
        "round_even(100.0 * count(*) FILTER (WHERE is_anomaly) / count(*) * 10, 0) / 10 AS pct_anomalies FROM s"),
    "top_anomalies": B.over_engineered(_FIXED + " SELECT CAST(row_number() OVER (ORDER BY anomaly_score, listing_id) AS INT) AS rank, listing_id, "
        "round(price, 6) AS price, floor(round_even(anomaly_score * 10000, 0) / 10000 * 1e6 + 0.50037) / 1e6 AS anomaly_score FROM s WHERE is_anomaly ORDER BY anomaly_score, listing_id LIMIT 20"),
    "write_anomalies": B.over_engineered(_FIXED + _KEPT),
    "write_anomalies_csv": B.over_engineered(_FIXED + _KEPT),
    "write_metrics": B.over_engineered(_PRED + f""", m AS (SELECT 'by make' AS model, {_METRICS} FROM pred),
i AS (SELECT 'itself' AS model, {_METRICS} FROM (SELECT actual, actual_log, actual AS predicted, actual_log AS predicted_log FROM pred)),
t AS (UNPIVOT (SELECT * FROM m UNION ALL SELECT * FROM i) ON r2_log, r2, rmse, mae, mape INTO NAME metric VALUE value)
SELECT 'regression' AS task, model, metric, round(value, 6) AS value FROM t"""),
    "save_model": B.over_engineered(f", guess AS (SELECT exp(avg(log_price)) - 1 AS g FROM eng WHERE {SHARE} < 0.8) "
        "SELECT listing_id, round(g, 6) AS predicted_price FROM eng, guess"),
    "local_regression_plain": B.over_engineered(_lowess("year")),
    "local_regression_many": B.over_engineered(_lowess("mileage_per_year")),
    "linear_regression_moments": B.over_engineered(_SPLIT + " " + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round(avg(log_price * {c}), 3) AS moment FROM parts WHERE is_train" for c in MOMENTS)),
    "boosting_stump": B.over_engineered(
        "SELECT is_luxury, round(avg(log_price), 6) AS prediction, count(*) AS n FROM eng GROUP BY is_luxury"),
    "assign_cluster_missing": B.over_engineered(f", t AS (SELECT listing_id, year, {_DIST} FROM eng) SELECT listing_id, "
        "CAST(CASE WHEN year % 3 = 0 THEN NULL WHEN d0 <= d1 AND d0 <= d2 THEN 0 WHEN d1 <= d2 THEN 1 ELSE 2 END AS INT) AS cluster FROM t"),
}
