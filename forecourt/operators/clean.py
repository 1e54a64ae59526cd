"""Cleaning of raw listings: one projection plus a small fitted imputation table."""

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.functions import text
from forecourt.operators.lookup import bounded
from forecourt.operators.quantiles import median


def strip_ws(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn(col, text.stripped(F.col(col)))


def to_number_or_null(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn(col, text.number_or_null(F.col(col)))


def display_name(df: DataFrame, col: str, name: str | None = None) -> DataFrame:
    return df.withColumn(name or f"{col}_display", text.titled(F.col(col)))


def extract_condition(df: DataFrame, col: str = "description") -> DataFrame:
    return df.withColumn("condition", text.condition_of(F.col(col)))


def extract_features(df: DataFrame, col: str = "description") -> DataFrame:
    return df.withColumn("features_list", text.amenities_of(F.col(col)))


@dataclass(frozen=True)
class GroupMedianImputer:
    """Fills gaps with the group's median, else with the overall one, as an integer.

    The overall median is that of the column after the group fill. Fractions are cut.
    """

    col: str
    by: str
    medians: DataFrame
    overall: float | None

    @classmethod
    def fit(cls, df: DataFrame, col: str, by: str) -> "GroupMedianImputer":
        # Both medians need only the (group, value) counts, so the data is read once.
        counts, _ = bounded(
            df.select(by, F.col(col).alias("_v")).groupBy(by, "_v").agg(F.count(F.lit(1)).alias("_n"))
        )
        medians, _ = bounded(median(counts, "_v", by, "_group_median", weight="_n"))
        filled = counts.join(medians, by, "left").withColumn(
            "_v", F.coalesce("_v", "_group_median")
        )
        overall = median(filled, "_v", weight="_n").first()
        return cls(col, by, medians, overall[0] if overall else None)

    def transform(self, df: DataFrame) -> DataFrame:
        filled = F.coalesce(
            F.col(self.col), F.col("_group_median"), F.lit(self.overall).cast("double")
        )
        return (
            df.join(self.medians, self.by, "left")
            .withColumn(self.col, filled.cast("int"))
            .select(*df.columns)
        )


def impute_group_median(df: DataFrame, col: str, by: str) -> DataFrame:
    return GroupMedianImputer.fit(df, col, by).transform(df)


def fit_cylinder_imputer(raw: DataFrame) -> GroupMedianImputer:
    return GroupMedianImputer.fit(to_number_or_null(raw, "cylinders"), "cylinders", "make")


def clean_listings(raw: DataFrame, imputer: GroupMedianImputer | None = None) -> DataFrame:
    """All cleaning steps. A fitted imputer is reused where given, e.g. for new listings."""
    numeric = to_number_or_null(strip_ws(raw, "location"), "cylinders")
    imputer = imputer or GroupMedianImputer.fit(numeric, "cylinders", "make")
    named = display_name(display_name(imputer.transform(numeric), "make"), "model")
    return extract_features(extract_condition(named))


def project_clean_preview(clean: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` listings by key, in reading order of the columns."""
    return (
        clean.select(
            "listing_id", "make", "make_display", "model", "model_display", "year", "price",
            "mileage", "body_type", "cylinders", "transmission", "fuel_type", "color",
            "location", "condition",
        )
        .orderBy("listing_id")
        .limit(n)
    )
