"""Sources, cleaning and feature engineering."""

from pyspark.sql import functions as F

from checks import base as B
from forecourt import schema as S
from forecourt import vocabulary as V
from forecourt.operators import clean as C
from forecourt.operators import features as E
from forecourt.sources import listings as L
from forecourt.sources import sinks
from forecourt.sources.tables import LUXURY_MAKES

_RAW = "make, model, year, price, mileage, body_type, {0}, transmission, fuel_type, color, location, description"
_NAMES = list(S.RAW_COLUMNS)


def _csv_listings(spark, d):
    path = B.scratch(spark)
    B.raw(spark, d).select(*_NAMES).write.option("header", True).option("escape", '"').csv(
        path, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )
    return L.read_listings_csv(spark, path).drop("listing_id")


def _parquet_listings(spark, d):
    path = B.scratch(spark)
    B.raw(spark, d).write.parquet(path)
    return L.read_listings(spark, path)


def _stored_predictions(spark, d):
    path = B.scratch(spark)
    rows = B.engineered(spark, d).select(
        F.col("price").alias("actual"), (F.col("price") * 0.9).alias("predicted"),
        F.col("log_price").alias("actual_log"), F.log1p(F.col("price") * 0.9).alias("predicted_log"),
    )
    sinks.write_predictions(rows, path)
    return B.rounded(sinks.read_predictions(spark, path))


def _stored_layer(spark, d):
    path = B.scratch(spark)
    L.write_layer(B.engineered(spark, d), path)
    return B.rounded(_listed(L.read_layer(spark, path)))


def _listed(df):
    return df.withColumn("features_list", F.array_join("features_list", "|"))


QUERIES = {
    "raw_listings": B.raw,
    "read_listings_csv": _csv_listings,
    "read_listings_parquet": _parquet_listings,
    "write_predictions": _stored_predictions,
    "strip_ws": lambda s, d: C.strip_ws(B.raw(s, d), "location").select("listing_id", "location"),
    "to_number_or_null": lambda s, d: C.to_number_or_null(B.raw(s, d), "cylinders").select("listing_id", "cylinders"),
    "impute_group_median": lambda s, d: C.impute_group_median(
        C.to_number_or_null(B.raw(s, d), "cylinders"), "cylinders", "make"
    ).select("listing_id", "cylinders"),
    "display_name": lambda s, d: C.display_name(C.display_name(B.raw(s, d), "make"), "model").select(
        "listing_id", "make_display", "model_display"
    ),
    "extract_condition": lambda s, d: C.extract_condition(B.raw(s, d)).select("listing_id", "condition"),
    "extract_features": lambda s, d: _listed(C.extract_features(B.raw(s, d))).select("listing_id", "features_list"),
    "clean_listings": lambda s, d: _listed(C.clean_listings(B.raw(s, d))),
    "clean_preview": lambda s, d: C.project_clean_preview(B.clean(s, d)),
    "car_age": lambda s, d: E.car_age(B.raw(s, d)).select("listing_id", "car_age"),
    "mileage_per_year": lambda s, d: B.rounded(
        E.mileage_per_year(E.car_age(B.raw(s, d))).select("listing_id", "mileage_per_year")
    ),
    "log_features": lambda s, d: B.rounded(E.log_features(B.raw(s, d)).select("listing_id", "log_price", "log_mileage")),
    "price_per_km": lambda s, d: B.rounded(E.price_per_km(B.raw(s, d)).select("listing_id", "price_per_km")),
    "condition_score": lambda s, d: E.condition_score(C.extract_condition(B.raw(s, d))).select(
        "listing_id", "condition", "condition_score"
    ),
    "feature_flags": lambda s, d: E.feature_flags(C.extract_features(B.raw(s, d))).select(
        "listing_id", *V.AMENITY_FLAGS
    ),
    "feature_count": lambda s, d: E.feature_count(C.extract_features(B.raw(s, d))).select("listing_id", "feature_count"),
    "is_luxury": lambda s, d: E.is_luxury(B.raw(s, d), LUXURY_MAKES).select("listing_id", "is_luxury"),
    "engineer_listings": lambda s, d: B.rounded(_listed(B.engineered(s, d))),
    "engineered_layer": _stored_layer,
}

_CLEAN_COLUMNS = _RAW.format("cylinders") + ", make_display, model_display, condition, array_to_string(features_list, '|') AS features_list"
_FLAG_NAMES = ", ".join(V.AMENITY_FLAGS)

ORACLES = {
    "raw_listings": B.over_raw("SELECT * FROM raw"),
    "read_listings_csv": B.over_raw(f"SELECT {_RAW.format('cylinders')} FROM raw"),
    "read_listings_parquet": B.over_raw("SELECT * FROM raw"),
    "write_predictions": B.over_engineered(
        "SELECT round(price, 6) AS actual, round(price * 0.9, 6) AS predicted, round(log_price, 6) AS actual_log, "
        "round(ln(1 + price * 0.9), 6) AS predicted_log FROM eng"
    ),
    "strip_ws": B.over_raw(f"SELECT listing_id, {B.STRIP.format('location')} AS location FROM raw"),
    "to_number_or_null": B.over_raw(
        "SELECT listing_id, CASE WHEN regexp_full_match(cylinders, '[0-9]+') THEN CAST(cylinders AS DOUBLE) END AS cylinders FROM raw"
    ),
    "impute_group_median": B.over_clean("SELECT listing_id, cylinders FROM clean"),
    "display_name": B.over_clean("SELECT listing_id, make_display, model_display FROM clean"),
    "extract_condition": B.over_clean("SELECT listing_id, condition FROM clean"),
    "extract_features": B.over_clean(
        "SELECT listing_id, array_to_string(features_list, '|') AS features_list FROM clean"
    ),
    "clean_listings": B.over_clean(f"SELECT listing_id, {_CLEAN_COLUMNS} FROM clean"),
    "clean_preview": B.over_clean(
        "SELECT listing_id, make, make_display, model, model_display, year, price, mileage, body_type, cylinders, "
        "transmission, fuel_type, color, location, condition FROM clean ORDER BY listing_id LIMIT 10"
    ),
    "car_age": B.over_engineered("SELECT listing_id, car_age FROM eng"),
    "mileage_per_year": B.over_engineered("SELECT listing_id, round(mileage_per_year, 6) AS mileage_per_year FROM eng"),
    "log_features": B.over_engineered(
        "SELECT listing_id, round(log_price, 6) AS log_price, round(log_mileage, 6) AS log_mileage FROM eng"
    ),
    "price_per_km": B.over_engineered("SELECT listing_id, round(price_per_km, 6) AS price_per_km FROM eng"),
    "condition_score": B.over_engineered("SELECT listing_id, condition, condition_score FROM eng"),
    "feature_flags": B.over_engineered(f"SELECT listing_id, {_FLAG_NAMES} FROM eng"),
    "feature_count": B.over_engineered("SELECT listing_id, feature_count FROM eng"),
    "is_luxury": B.over_engineered("SELECT listing_id, is_luxury FROM eng"),
    "engineer_listings": B.over_engineered(
        f"SELECT listing_id, {_CLEAN_COLUMNS.replace(', price,', ', round(price, 6) AS price,')}, car_age, "
        "round(mileage_per_year, 6) AS mileage_per_year, round(log_price, 6) AS log_price, "
        "round(log_mileage, 6) AS log_mileage, round(price_per_km, 6) AS price_per_km, condition_score, "
        f"{_FLAG_NAMES}, feature_count, is_luxury FROM eng"
    ),
}
ORACLES["engineered_layer"] = ORACLES["engineer_listings"]
