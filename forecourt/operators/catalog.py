"""What occurs in a listings table. Long form, so no list is gathered in one row."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.functions.numeric import long_form
from forecourt.operators.grouping import top_k_per_group

FIELDS = ("make", "body_type", "fuel_type", "color", "location", "transmission", "cylinders")


def catalog(df: DataFrame, fields: Sequence[str] = FIELDS) -> DataFrame:
    """Distinct values of every field as (field, value)."""
    return long_form(df, list(fields), "field").dropna().distinct()


def year_range(df: DataFrame) -> DataFrame:
    return df.agg(F.min("year").alias("min_year"), F.max("year").alias("max_year"))


def models_by_make(df: DataFrame) -> DataFrame:
    """Distinct (make, model) pairs."""
    return df.select("make", "model").dropna().distinct()


def table_shape(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
    ).withColumn("n_cols", F.lit(len(df.columns)))


def valid_values_top_k(df: DataFrame, by: str, col: str = "cylinders", k: int = 4) -> DataFrame:
    """The ``k`` most frequent values per group, most frequent first, as an array."""
    ranked = top_k_per_group(df, by, col, k)
    pairs = F.array_sort(F.collect_list(F.struct("rank", col)))
    return ranked.groupBy(by).agg(F.transform(pairs, lambda p: p[col]).alias(f"valid_{col}"))
