"""Bulk assessment of candidate listings: what one form evaluates, for a whole table."""

from pyspark.ml import Transformer
from pyspark.sql import DataFrame

from forecourt import vocabulary as V
from forecourt.operators import scoring
from forecourt.operators.anomaly import IsolationForest
from forecourt.operators.regress import predict_price


def assess(candidates: DataFrame, reference: DataFrame, model: Transformer, forest: IsolationForest,
           luxury_makes=V.LUXURY_MAKES, economy_makes=V.ECONOMY_MAKES) -> DataFrame:
    """Price estimate, deal rating, anomaly flag, broken rules and comparables per candidate."""
    features = scoring.candidate_features(candidates, luxury_makes)
    rated = scoring.rate_deal(predict_price(features, model))
    flagged = scoring.flag_deal_anomaly(rated, forest)
    checked = scoring.validate_configuration(
        flagged, reference, luxury_makes=luxury_makes, economy_makes=economy_makes
    )
    return scoring.comparables_stats(checked, reference)
