"""Scoring candidate listings, in batches or as a stream, against models and comparables.

Reference tables are reduced to one row per key before they meet the candidates, so no
candidate is ever paired with the listings behind its statistics.
"""

from collections.abc import Iterable

from pyspark.ml import Transformer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt import vocabulary as V
from forecourt.functions.numeric import known
from forecourt.operators.anomaly import IsolationForest, score_isolation_forest
from forecourt.operators.catalog import valid_values_top_k
from forecourt.operators.features import engineer_listings
from forecourt.operators.lookup import lookup_join
from forecourt.operators.regress import predict_price
from forecourt.operators.segment import Projection, SegmentModel, assign_cluster
from forecourt.operators.sliding import cell_counts, sliding_boxes, sliding_quantiles, sliding_totals
from forecourt.session import discard, stored

BODY_RULE, MAKE_RULE, LUXURY_RULE, ECONOMY_RULE = "body_type", "make", "luxury", "economy"


def candidate_features(candidates: DataFrame, luxury_makes: Iterable[str] = V.LUXURY_MAKES) -> DataFrame:
    """The engineered columns of already structured input, by the same expressions."""
    return engineer_listings(candidates, luxury_makes=luxury_makes)


def comparables_index(reference: DataFrame, years: int = 2) -> DataFrame:
    """Count, least, median and largest price of every (make, year) with listings of the make within ``years``.

    A table in the shared folder, one row per key: batches and streams of candidates join it alike.
    """
    by = ["make"]
    counts = stored(cell_counts(reference, "price", by, "year"), "comparables-cells")
    totals = sliding_totals(counts, by, "year", years).select(
        *by, "year", F.col("count").alias("n_comparables"), F.col("min").alias("min_price"), F.col("max").alias("max_price")
    )
    medians = sliding_quantiles(reference, "price", {"median_price": 0.5}, by, "year", years, counts)
    index = stored(totals.join(medians, [*by, "year"]), "comparables")
    discard(counts)
    return index


def comparables_box_index(reference: DataFrame, years: int = 3, more_than: int = 2) -> DataFrame:
    """Box statistics of every (make, body type, year) with more than ``more_than`` such listings within ``years``.

    A table in the shared folder, as that of :func:`comparables_index`.
    """
    by = ["make", "body_type"]
    counts = stored(cell_counts(reference, "price", by, "year"), "comparables-cells")
    boxes = sliding_boxes(reference, "price", by, "year", years, counts).where(F.col("count") > more_than)
    index = stored(boxes.withColumnRenamed("count", "n_comparables"), "comparables-boxes")
    discard(counts)
    return index


def comparables_stats(candidates: DataFrame, reference: DataFrame, years: int = 2,
                      index: DataFrame | None = None) -> DataFrame:
    """Adds count, minimum, median and maximum price of the same make within ``years``.

    ``candidates`` may be a stream. An ``index`` made before takes the place of ``reference``.
    A candidate without make or year has no comparables.
    """
    index = comparables_index(reference, years) if index is None else index
    return lookup_join(candidates, index, ["make", "year"]).withColumn(
        "n_comparables", F.coalesce("n_comparables", F.lit(0)).cast("bigint")
    )


def comparables_by_body(candidates: DataFrame, reference: DataFrame, years: int = 3,
                        more_than: int = 2, index: DataFrame | None = None) -> DataFrame:
    """Box statistics of the same make and body type within ``years``, where there are enough.

    ``candidates`` may be a stream. An ``index`` made before takes the place of ``reference``.
    """
    index = comparables_box_index(reference, years, more_than) if index is None else index
    return lookup_join(candidates, index, ["make", "body_type", "year"])


def rate_deal(df: DataFrame, listed: str = "listed_price", predicted: str = "predicted_price") -> DataFrame:
    """Adds the difference to the prediction, in percent too, and the rating it gives.

    The percentage is 0 for a prediction of 0 or less. Where either price is missing, all
    three are NULL.
    """
    asked, guess = known(F.col(listed)), known(F.col(predicted))
    difference = asked - guess
    pct = F.when(guess <= 0, difference * 0.0).otherwise(100 * F.try_divide(difference, guess))
    rating = F.lit(V.DEAL_RATING_ABOVE)
    for bound, name in reversed(V.DEAL_RATINGS):
        rating = F.when(F.col("price_diff_pct") < bound, name).otherwise(rating)
    return (
        df.withColumn("price_diff", difference)
        .withColumn("price_diff_pct", pct)
        .withColumn("deal_rating", F.when(F.col("price_diff_pct").isNotNull(), rating))
    )


def flag_deal_anomaly(df: DataFrame, forest: IsolationForest, listed: str = "listed_price") -> DataFrame:
    """Isolation score of each candidate at its listed price."""
    extra = [c for c in df.columns if c != "price"]
    scored = score_isolation_forest(df.withColumn("price", F.col(listed).cast("double")), forest)
    return scored.select(*extra, "anomaly_score", "is_anomaly")


def validate_configuration(candidates: DataFrame, reference: DataFrame, k: int = 4,
                           luxury_makes: Iterable[str] = V.LUXURY_MAKES,
                           economy_makes: Iterable[str] = V.ECONOMY_MAKES) -> DataFrame:
    """Adds the broken rules and whether there are none; an unknown key skips its rule."""
    by_body = valid_values_top_k(reference, "body_type", k=k).withColumnRenamed("valid_cylinders", "_by_body")
    by_make = valid_values_top_k(reference, "make", k=k).withColumnRenamed("valid_cylinders", "_by_make")
    joined = lookup_join(lookup_join(candidates, by_body, "body_type"), by_make, "make")
    cylinders = F.col("cylinders")
    rules = (
        (BODY_RULE, ~F.array_contains("_by_body", cylinders)),
        (MAKE_RULE, ~F.array_contains("_by_make", cylinders)),
        (LUXURY_RULE, F.col("make").isin(*luxury_makes) & (cylinders < V.LUXURY_MIN_CYLINDERS)),
        (ECONOMY_RULE, F.col("make").isin(*economy_makes) & (cylinders >= V.ECONOMY_MAX_CYLINDERS)),
    )
    broken = F.array_compact(F.array(*[F.when(test, name) for name, test in rules]))
    return (
        joined.withColumn("broken_rules", broken)
        .withColumn("is_plausible", F.size("broken_rules") == 0)
        .select(*candidates.columns, "broken_rules", "is_plausible")
    )


def assign_segment(candidates: DataFrame, model: Transformer, segments: SegmentModel,
                   projection: Projection, named_profiles: DataFrame) -> DataFrame:
    """Predicted price, nearest segment, its profile, and the point in the projected plane."""
    priced = predict_price(candidates, model)
    at_prediction = priced.withColumn("price", F.col("predicted_price"))
    placed = projection.transform(
        assign_cluster(at_prediction, list(segments.scaler.means), segments.centers, segments.scaler)
    ).drop("price")
    return lookup_join(placed, named_profiles, "cluster")
