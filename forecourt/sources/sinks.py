"""Sinks for results and fitted models. All of them write in parallel, part by part."""

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt import schema as S
from forecourt.operators.anomaly import IsolationForest
from forecourt.operators.prep import Scaler
from forecourt.operators.segment import Projection, SegmentModel


def _write(df: DataFrame, path: str, fmt: str, mode: str) -> None:
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer = writer.option("header", True).option("escape", '"')
    writer.format(fmt).save(path)


def _read(spark: SparkSession, path: str, fmt: str, schema) -> DataFrame:
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True).option("escape", '"')
    return reader.format(fmt).load(path)


def _conform(df: DataFrame, schema) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def write_predictions(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    _write(_conform(df, S.PREDICTIONS), path, fmt, mode)


def read_predictions(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return _read(spark, path, fmt, S.PREDICTIONS)


def write_anomalies(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    _write(_conform(df, S.ANOMALIES), path, fmt, mode)


def read_anomalies(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return _read(spark, path, fmt, S.ANOMALIES)


def write_metrics(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    _write(_conform(df, S.METRICS), path, "json", mode)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, "json", S.METRICS)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def save_forest(forest: IsolationForest, path: str) -> None:
    """Nodes, and what scoring needs besides: features, sample size and the fitted offset."""
    _write(_conform(forest.nodes, S.ISOLATION_NODES), f"{path}/nodes", "parquet", "overwrite")
    row = [(forest.features, forest.sample, forest.offset)]
    described = forest.nodes.sparkSession.createDataFrame(row, "features array<string>, sample int, offset double")
    _write(described.coalesce(1), f"{path}/settings", "json", "overwrite")


def load_forest(spark: SparkSession, path: str) -> IsolationForest:
    nodes = _read(spark, f"{path}/nodes", "parquet", S.ISOLATION_NODES)
    row = spark.read.schema("features array<string>, sample int, offset double").json(f"{path}/settings").first()
    return IsolationForest(nodes, list(row["features"]), row["sample"], row["offset"])


def save_segments(segments: SegmentModel, projection: Projection, path: str) -> None:
    """Scaler, centers, sweep and projection as JSON tables that any reader understands."""
    spark = segments.sweep.sparkSession
    scaler = segments.scaler
    scaling = [(c, float(scaler.means[c]), float(scaler.deviations[c])) for c in scaler.means]
    centers = [(i, [float(v) for v in c]) for i, c in enumerate(segments.centers)]
    own = projection.scaler
    loadings = [
        ([[float(v) for v in row] for row in projection.loadings], [float(v) for v in projection.explained],
         list(own.means), [float(v) for v in own.means.values()], [float(own.deviations[c]) for c in own.means])
    ]
    for name, rows, kind in (
        ("scaling", scaling, "feature string, mean double, deviation double"),
        ("centers", centers, "cluster int, center array<double>"),
        ("projection", loadings, _PROJECTION),
    ):
        _write(spark.createDataFrame(rows, kind).coalesce(1), f"{path}/{name}", "json", "overwrite")
    _write(segments.sweep, f"{path}/sweep", "parquet", "overwrite")


_PROJECTION = (
    "loadings array<array<double>>, explained array<double>, features array<string>, means array<double>, deviations array<double>"
)


def load_segments(spark: SparkSession, path: str) -> tuple[SegmentModel, Projection]:
    scaling = spark.read.schema("feature string, mean double, deviation double").json(f"{path}/scaling").collect()
    scaler = Scaler({r.feature: r.mean for r in scaling}, {r.feature: r.deviation for r in scaling})
    rows = spark.read.schema("cluster int, center array<double>").json(f"{path}/centers").orderBy("cluster").collect()
    p = spark.read.schema(_PROJECTION).json(f"{path}/projection").first()
    own = Scaler(dict(zip(p.features, p.means)), dict(zip(p.features, p.deviations)))
    segments = SegmentModel(scaler, [list(r.center) for r in rows], spark.read.parquet(f"{path}/sweep"), len(rows))
    return segments, Projection(own, [list(r) for r in p.loadings], list(p.explained))
