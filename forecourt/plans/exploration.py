"""The exploratory report: every exhibit as a lazily evaluated table."""

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

from forecourt import vocabulary as V
from forecourt.operators import correlation, distribution, grouping, profile, smoothing

CORRELATED = (
    "price", "year", "mileage", "cylinders", "car_age", "mileage_per_year", "condition_score",
    "feature_count", "is_luxury", "log_price",
)


def overview(raw: DataFrame, clean: DataFrame) -> dict[str, Callable[[], DataFrame]]:
    """Data overview: profile, quality and the effect of cleaning."""
    numeric = ["year", "price", "mileage"]
    return {
        "columns": lambda: profile.column_profile(raw),
        "numeric_summary": lambda: profile.describe_numeric(raw, numeric),
        "categorical_summary": lambda: profile.categorical_profile(raw, V.CATEGORICAL_FEATURES),
        "missing": lambda: profile.missing_report(raw),
        "sentinels": lambda: profile.sentinel_report(raw, {"cylinders": "Unknown", "model": "other"}),
        "cylinders": lambda: profile.value_counts(raw, "cylinders"),
        "locations": lambda: profile.distinct_before_after(raw, "location"),
        "conditions": lambda: profile.value_shares(clean, "condition"),
    }


def exhibits(engineered: DataFrame, places: Sequence[str] = ()) -> dict[str, Callable[[], DataFrame]]:
    """Univariate, bivariate and multivariate exhibits. ``places`` are the locations compared."""
    e = engineered
    places = list(places)
    return {
        "price_histogram": lambda: distribution.histogram(e, "price", 80),
        "log_price_histogram": lambda: distribution.histogram(e, "log_price", 60),
        "mileage_histogram": lambda: distribution.histogram(e, "mileage", 60),
        "years": lambda: profile.value_counts(e, "year", sort="value"),
        "top_makes": lambda: profile.value_counts(e, "make_display", 20),
        **{c: (lambda c=c: profile.value_counts(e, c)) for c in V.CATEGORICAL_FEATURES if c != "make"},
        "amenities": lambda: profile.feature_frequency(e),
        "outliers": lambda: distribution.outlier_summary(e, "price"),
        "outlier_makes": lambda: distribution.outlier_composition(e, "price", "make_display"),
        "outlier_bodies": lambda: distribution.outlier_composition(e, "price", "body_type", None),
        "segments": lambda: grouping.segment_summary(e),
        "segment_ratios": lambda: grouping.segment_ratios(e),
        "segment_density": lambda: distribution.density_curve(grouping.with_segment(e), "price", "segment"),
        "penetration": lambda: grouping.feature_penetration(e),
        "segment_bodies": lambda: grouping.top_k_per_group(grouping.with_segment(e), "segment", "body_type", 5),
        "price_by_year": lambda: smoothing.local_regression(e, "year", "price"),
        "price_by_mileage": lambda: smoothing.local_regression(e, "mileage", "price"),
        "depreciation": lambda: grouping.median_trend(e),
        "price_by_make": lambda: distribution.box_stats(
            grouping.restrict_to_top_k(e, "make_display", 15), "price", "make_display"),
        "make_order": lambda: grouping.group_order_by_median(
            grouping.restrict_to_top_k(e, "make_display", 15), "make_display"),
        "price_by_body": lambda: distribution.density_curve(
            grouping.restrict_to_top_k(e, "body_type", 8), "price", "body_type"),
        "price_by_place": lambda: distribution.box_stats(
            grouping.filter_values(e, "location", places) if places else e, "price", "location"),
        "price_by_cylinders": lambda: distribution.box_stats(e, "price", "cylinders"),
        "correlations": lambda: correlation.correlation_matrix(e, CORRELATED),
        "price_correlations": lambda: correlation.correlation_with_target(e, V.NUMERIC_FEATURES),
        "composition": lambda: grouping.hierarchy_counts(
            e, ["location", "body_type", "fuel_type"], {"location": places} if places else {}),
        "make_by_body": lambda: grouping.median_pivot(e),
        "colors_by_place": lambda: grouping.share_within_group(e, "location", "color", 5, places),
        "most_expensive": lambda: distribution.top_k(e, "price", 10),
        "price_by_condition": lambda: grouping.reindexed_group_stat(e),
        "price_by_feature_count": lambda: grouping.group_mean(e),
    }
