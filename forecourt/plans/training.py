"""The training job: listings in, models, tables and metrics out."""

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from forecourt import schema as S
from forecourt.operators import anomaly, catalog, classify, distribution, grouping, regress, segment
from forecourt.session import stored
from forecourt.sources import sinks


def dataset_metadata(engineered: DataFrame) -> dict[str, DataFrame]:
    """What forms and validation need to know about the listings, as small tables."""
    return {
        "shape": catalog.table_shape(engineered),
        "catalog": catalog.catalog(engineered),
        "year_range": catalog.year_range(engineered),
        "models_by_make": catalog.models_by_make(engineered),
        "valid_cylinders_by_body_type": catalog.valid_values_top_k(engineered, "body_type"),
        "valid_cylinders_by_make": catalog.valid_values_top_k(engineered, "make"),
        "price_stats": distribution.price_stats(engineered),
        "segment_stats": grouping.segment_summary(engineered),
    }


@dataclass
class Trained:
    metrics: DataFrame
    prices: regress.PriceModels
    body_types: classify.BodyTypeModels
    segments: segment.SegmentModel
    projection: segment.Projection
    profiles: DataFrame
    forest: anomaly.IsolationForest
    anomalies: DataFrame
    placed: DataFrame
    metadata: dict[str, DataFrame] = field(default_factory=dict)


def train(engineered: DataFrame, regression_sizes: Mapping[str, Mapping[str, int]] = regress.SIZES,
          classifier_sizes: Mapping[str, Mapping[str, int]] = classify.SIZES,
          regressors: Sequence[str] | None = None, cv_folds: int = 5,
          ks: Iterable[int] = range(2, 11), n_init: int = 10, seed: int = 42) -> Trained:
    """Every model of the project on one engineered table, which is stored for the duration."""
    rows = stored(engineered, "engineered")
    spark = rows.sparkSession
    prices = regress.train_regression(rows, regressors, regression_sizes, cv_folds, seed)
    bodies = classify.train_classification(rows, sizes=classifier_sizes, seed=seed)
    segments = segment.kmeans_sweep(rows, tuple(ks), n_init, seed)
    projection = segment.fit_projection(rows)
    clustered = segment.assign_cluster(rows, list(segments.scaler.means), segments.centers, segments.scaler)
    profiles = segment.name_segments(segment.cluster_profiles(clustered))
    forest = anomaly.fit_isolation_forest(rows, seed=seed)
    scored = anomaly.score_isolation_forest(rows, forest)

    extra: list[tuple[str, str, str, float]] = []
    for k, inertia, quality in segments.sweep.collect():
        extra += [("clustering", f"k={k}", "inertia", inertia), ("clustering", f"k={k}", "silhouette", quality)]
    extra.append(("clustering", "K-Means", "optimal_k", float(segments.k)))
    extra += [
        ("clustering", f"PC{i + 1}", "explained_variance", v) for i, v in enumerate(projection.explained)
    ]
    found = anomaly.anomaly_summary(scored).first().asDict()
    extra += [("anomaly_detection", "Isolation Forest", name, float(v)) for name, v in found.items()]
    extra.append(("anomaly_detection", "Isolation Forest", "contamination", anomaly.CONTAMINATION))
    metrics = prices.metrics.unionByName(bodies.metrics).unionByName(spark.createDataFrame(extra, S.METRICS))
    anomalies = anomaly.anomaly_table(anomaly.score_isolation_forest(rows, forest))
    placed = projection.transform(
        segment.assign_cluster(rows, list(segments.scaler.means), segments.centers, segments.scaler)
    ).select("listing_id", "cluster", "pc1", "pc2")
    return Trained(
        metrics, prices, bodies, segments, projection, profiles, forest, anomalies, placed,
        dataset_metadata(rows),
    )


def save(trained: Trained, folder: str) -> None:
    """Models, node table, result tables, metrics and metadata under one folder.

    Among them every classifier's confusion matrix and report, every listing's cluster and place in
    the plane, and, as ``metadata/chosen``, the best models' names and the number of clusters.
    """
    for name, model in trained.prices.models.items():
        sinks.save_model(model, f"{folder}/price_{_file(name)}")
    for name, model in trained.body_types.models.items():
        sinks.save_model(model, f"{folder}/bodytype_{_file(name)}")
    sinks.save_forest(trained.forest, f"{folder}/isolation_forest")
    sinks.save_segments(trained.segments, trained.projection, f"{folder}/segments")
    sinks.write_predictions(trained.prices.predictions, f"{folder}/regression_test_results")
    sinks.write_anomalies(trained.anomalies, f"{folder}/anomaly_results")
    sinks.write_metrics(trained.metrics, f"{folder}/metrics")
    for name, table in trained.prices.importances.items():
        table.write.mode("overwrite").parquet(f"{folder}/feature_importance_{_file(name)}")
    for name in trained.body_types.models:
        trained.body_types.confusion[name].write.mode("overwrite").parquet(f"{folder}/confusion_{_file(name)}")
        trained.body_types.reports[name].write.mode("overwrite").parquet(f"{folder}/report_{_file(name)}")
    trained.placed.write.mode("overwrite").parquet(f"{folder}/cluster_assignments")
    choices = [("regression", trained.prices.best), ("classification", trained.body_types.best), ("clustering", str(trained.segments.k))]
    chosen = trained.metrics.sparkSession.createDataFrame(choices, "task string, chosen string")
    for name, table in {**trained.metadata, "profiles": trained.profiles, "chosen": chosen}.items():
        table.write.mode("overwrite").parquet(f"{folder}/metadata/{name}")


def _file(name: str) -> str:
    return name.lower().replace(" ", "_")
