"""The same assessment over a stream of candidates.

Every step is stateless: derived columns, model scoring, ratings and lookups in static
tables that were reduced beforehand. No watermark or state is involved.
"""

from pyspark.ml import Transformer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from forecourt import vocabulary as V
from forecourt.operators import scoring
from forecourt.operators.anomaly import IsolationForest
from forecourt.operators.regress import predict_price


def rate_stream(candidates: DataFrame, reference: DataFrame, model: Transformer,
                forest: IsolationForest | None = None, luxury_makes=V.LUXURY_MAKES,
                economy_makes=V.ECONOMY_MAKES) -> DataFrame:
    """Streaming candidates with estimate, rating, rules, comparables and, given a forest, the anomaly flag.

    The comparables are those of ``reference`` when this is called.
    """
    features = scoring.candidate_features(candidates, luxury_makes)
    rated = scoring.rate_deal(predict_price(features, model))
    if forest is not None:
        rated = scoring.flag_deal_anomaly(rated, forest)
    checked = scoring.validate_configuration(
        rated, reference, luxury_makes=luxury_makes, economy_makes=economy_makes
    )
    return scoring.comparables_stats(checked, reference)


def write_rated(rated: DataFrame, path: str, checkpoint_path: str, once: bool = False) -> StreamingQuery:
    """Append rated candidates to Parquet, exactly once per input row."""
    writer = (
        rated.withColumn("rated_at", F.current_timestamp())
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint_path)
        .outputMode("append")
    )
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start()
