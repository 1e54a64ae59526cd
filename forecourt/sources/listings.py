"""Readers for raw listings and the raw -> clean -> engineered layers."""

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forecourt import schema as S
from forecourt import vocabulary as V
from forecourt.functions.text import number_or_null
from forecourt.operators.clean import GroupMedianImputer, clean_listings
from forecourt.operators.features import engineer_listings
from forecourt.sources.tables import spread


def _present(c: Column) -> Column:
    return F.when(~c.isin(*V.CSV_MISSING), c)


def read_listings_csv(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Raw listings from CSV with a header, under a fixed schema (no inference pass).

    Every field is read as text, then missing-value spellings become NULL and the
    numbers are cast, so one bad field never discards its row. Files stay splittable
    unless ``multiline`` is asked for. A file has no key, so ``listing_id`` is a 128-bit
    hash of the row and a number among equal rows, whatever the files and their splits.
    """
    text = T.StructType([T.StructField(c, T.StringType()) for c in S.RAW_COLUMNS])
    raw = (
        spark.read.schema(text)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multiline)
        .option("enforceSchema", True)
        .csv(path)
    )
    types = {f.name: f.dataType for f in S.RAW.fields}
    columns = []
    for name in S.RAW_COLUMNS:
        kept = _present(F.col(name))
        if not isinstance(types[name], T.StringType):
            kept = number_or_null(kept).try_cast(types[name])
        columns.append(kept.alias(name))
    rows = raw.select(*columns)
    hashes = [F.xxhash64(F.lit(salt), *S.RAW_COLUMNS) for salt in (0, 1)]
    rows = rows.withColumns({"_h": hashes[0], "_g": hashes[1]})
    # Equal rows are interchangeable, so any order among them gives the same listings.
    number = F.row_number().over(Window.partitionBy("_h", "_g").orderBy(F.lit(0)))
    key = F.concat_ws("-", F.hex("_h"), F.hex("_g"), number.cast("string"))
    return rows.select(key.alias("listing_id"), *S.RAW_COLUMNS)


def read_listings(spark: SparkSession, path: str) -> DataFrame:
    """Raw listings stored as Parquet; NaN is NULL."""
    stored = spark.read.schema(S.RAW).parquet(path)
    floats = {f.name: F.nanvl(f.name, F.lit(None)) for f in S.RAW.fields if isinstance(f.dataType, T.DoubleType)}
    return spread(stored.withColumns(floats), "listing_id")


def write_layer(listings: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Store a layer (raw, clean or engineered), so that later steps read what they need of it."""
    listings.write.mode(mode).parquet(path)


def read_layer(spark: SparkSession, path: str) -> DataFrame:
    """A stored layer, under the schema that it was written with."""
    return spread(spark.read.parquet(path), "listing_id")


def clean_layer(raw: DataFrame, imputer: GroupMedianImputer | None = None) -> DataFrame:
    return clean_listings(raw, imputer)


def engineered_layer(raw: DataFrame, imputer: GroupMedianImputer | None = None,
                     luxury_makes: Iterable[str] = V.LUXURY_MAKES) -> DataFrame:
    return engineer_listings(clean_listings(raw, imputer), luxury_makes=luxury_makes)
