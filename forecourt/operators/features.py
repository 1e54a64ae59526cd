"""Engineered columns. Every operator is a projection, so nothing shuffles."""

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt import vocabulary as V
from forecourt.functions import listing as L


def car_age(df: DataFrame, reference_year: int = V.REFERENCE_YEAR) -> DataFrame:
    return df.withColumn("car_age", L.car_age(F.col("year"), reference_year))


def mileage_per_year(df: DataFrame) -> DataFrame:
    return df.withColumn("mileage_per_year", F.col("mileage") / F.col("car_age"))


def log_features(df: DataFrame) -> DataFrame:
    columns = [c for c in ("price", "mileage") if c in df.columns]
    return df.withColumns({f"log_{c}": F.log1p(c) for c in columns})


def price_per_km(df: DataFrame) -> DataFrame:
    return df.withColumn("price_per_km", L.price_per_km(F.col("price"), F.col("mileage")))


def condition_score(df: DataFrame) -> DataFrame:
    return df.withColumn("condition_score", L.condition_score(F.col("condition")))


def feature_flags(df: DataFrame, amenities: Iterable[str] = V.AMENITIES) -> DataFrame:
    listed = F.col("features_list")
    return df.withColumns({V.flag_name(a): L.has_amenity(listed, a) for a in amenities})


def feature_count(df: DataFrame) -> DataFrame:
    return df.withColumn("feature_count", F.size("features_list"))


def is_luxury(df: DataFrame, makes: Iterable[str] = V.LUXURY_MAKES) -> DataFrame:
    return df.withColumn("is_luxury", L.is_luxury(F.col("make"), makes))


def engineer_listings(clean: DataFrame, reference_year: int = V.REFERENCE_YEAR,
                      luxury_makes: Iterable[str] = V.LUXURY_MAKES) -> DataFrame:
    """All engineered columns; adjacent projections collapse into one."""
    aged = mileage_per_year(car_age(clean, reference_year))
    logged = log_features(aged)
    if "price" in clean.columns:
        logged = price_per_km(logged)
    counted = feature_count(feature_flags(condition_score(logged)))
    return is_luxury(counted, luxury_makes)
