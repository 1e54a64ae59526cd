"""Data profiling and quality reports.

Per-column questions are asked of one melted table, ``(column, value, n)``: a single scan
whose map-side combine collapses repeats, spread over (column, value) so that no column
ends up in one task.
"""

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forecourt import vocabulary as V
from forecourt.functions.numeric import (
    known, long_form, percent, round_half_even, scalar_row,
)
from forecourt.functions.text import stripped
from forecourt.operators.quantiles import approximate_quantiles, quantiles


def _melted_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return long_form(df, list(cols)).groupBy("column", "value").agg(
        F.count(F.lit(1)).alias("n")
    )


def column_profile(df: DataFrame, cols: Sequence[str] | None = None, samples: int = 4,
                   approximate: bool = False) -> DataFrame:
    """Type, non-null count, distinct count and the smallest sample values per column.

    ``approximate`` swaps the exact distinct count, which shuffles every distinct value,
    for a sketch computed in one scan; sample values are then left out.
    """
    cols = list(cols or df.columns)
    types = dict(df.dtypes)
    names = df.sparkSession.createDataFrame(
        [(i, c, types[c]) for i, c in enumerate(cols)], "position int, column string, type string"
    )
    if approximate:
        row = df.agg(*[
            F.struct(F.count(c).alias("non_null"),
                     F.approx_count_distinct(c).alias("unique_values")).alias(c)
            for c in cols
        ])
        entries = F.array(*[F.struct(F.lit(c).alias("column"), f"`{c}`.*") for c in cols])
        found = row.select(F.inline(entries))
        return names.join(found, "column").select("column", "type", "non_null", "unique_values")

    counts = _melted_counts(df, cols).where(F.col("value").isNotNull())
    sizes = counts.groupBy("column").agg(
        F.sum("n").alias("non_null"), F.count(F.lit(1)).alias("unique_values")
    )
    # Spark keeps only the first rows of each partition before shuffling a ranked group.
    # The count travels along so that both branches share one exchange of ``counts``.
    smallest = Window.partitionBy("column").orderBy("value")
    pairs = F.array_sort(F.collect_list(F.struct("value", "n")))
    shown = (
        counts.withColumn("_rank", F.row_number().over(smallest))
        .where(F.col("_rank") <= samples)
        .groupBy("column")
        .agg(F.array_join(F.transform(pairs, lambda p: p["value"]), ", ").alias("sample_values"))
    )
    return (
        names.join(sizes, "column", "left")
        .join(shown, "column", "left")
        .select(
            "column", "type",
            F.coalesce("non_null", F.lit(0)).cast("bigint").alias("non_null"),
            F.coalesce("unique_values", F.lit(0)).cast("bigint").alias("unique_values"),
            "sample_values",
        )
    )


def describe_numeric(df: DataFrame, cols: Sequence[str], approximate: bool = False) -> DataFrame:
    """Count, mean, sample deviation, extremes and quartiles, rounded to 2 digits."""
    values = long_form(df, list(cols), cast="double").withColumn("value", known(F.col("value")))
    moments = values.groupBy("column").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"), F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    search = approximate_quantiles if approximate else quantiles
    quartiles = search(values, "value", {"p25": 0.25, "p50": 0.5, "p75": 0.75}, "column")
    numbers = ["mean", "std", "min", "p25", "p50", "p75", "max"]
    return moments.join(quartiles, "column", "left").select(
        "column", F.col("count").cast("bigint").alias("count"),
        *[round_half_even(F.col(c), 2).alias(c) for c in numbers],
    )


def categorical_profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct values, mode (the smallest on ties), its frequency and share of rows."""
    present = F.col("value").isNotNull()
    first = F.when(present, F.struct((-F.col("n")).alias("n"), "value"))
    return (
        _melted_counts(df, cols)
        .groupBy("column")
        .agg(
            F.count("value").alias("unique_values"), F.min(first).alias("_top"),
            F.sum("n").alias("_rows"),
        )
        .select(
            "column", "unique_values", F.col("_top.value").alias("most_frequent"),
            (-F.col("_top.n")).alias("top_frequency"),
            round_half_even(percent(-F.col("_top.n"), F.col("_rows")), 1).alias("top_pct"),
        )
    )


def missing_report(df: DataFrame) -> DataFrame:
    """Missing values per column, for the columns that have any; one scan, one row."""
    def missing(name: str, kind: str):
        gap = F.col(name).isNull()
        return gap | F.isnan(name) if kind in ("double", "float") else gap

    row = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(missing(c, kind)).alias(c) for c, kind in df.dtypes],
    )
    return (
        long_form(row, df.columns, value="missing_count", cast="bigint", keep=["_rows"])
        .where(F.col("missing_count") > 0)
        .select(
            "column", "missing_count",
            round_half_even(percent(F.col("missing_count"), F.col("_rows")), 2).alias("missing_pct"),
        )
    )


def sentinel_report(df: DataFrame, sentinels: Mapping[str, str]) -> DataFrame:
    """How often a column holds the word that stands for a missing value."""
    row = df.agg(*[
        F.count_if(F.col(c).cast("string") == word).alias(c) for c, word in sentinels.items()
    ])
    words = F.create_map(*[F.lit(x) for kv in sentinels.items() for x in kv])
    return long_form(row, list(sentinels), value="n", cast="bigint").select(
        "column", words[F.col("column")].alias("sentinel"), "n"
    )


def value_counts(df: DataFrame, col: str, n: int | None = None, sort: str = "count") -> DataFrame:
    """Frequencies of the non-null values, most frequent first or in value order.

    Ties go by value. With ``n`` the sort becomes a per-partition top-n.
    """
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    if sort not in ("count", "value"):
        raise ValueError(f"unknown sort {sort!r}")
    order = [F.col(col)] if sort == "value" else [F.desc("count"), F.col(col)]
    ordered = counts.orderBy(*order)
    return ordered if n is None else ordered.limit(n)


def value_shares(df: DataFrame, col: str) -> DataFrame:
    """Frequencies with their share of all rows in percent."""
    rows = scalar_row(df.agg(F.count(F.lit(1)).alias("rows")))
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    return counts.withColumn("pct", percent(F.col("count"), rows["rows"])).orderBy(
        F.desc("count"), col
    )


def feature_frequency(engineered: DataFrame, amenities: Iterable[str] = V.AMENITIES) -> DataFrame:
    """Listings with each amenity, rarest first; amenities nobody lists stay in."""
    flags = {a: V.flag_name(a) for a in amenities}
    row = engineered.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.sum(c).alias(a) for a, c in flags.items()]
    )
    return (
        long_form(row, list(flags), "amenity", "listings", "bigint", keep=["_rows"])
        .select("amenity", "listings", percent(F.col("listings"), F.col("_rows")).alias("pct"))
        .orderBy("listings", "amenity")
    )


def filter_listings(df: DataFrame, makes: Sequence[str] = (),
                    year_range: tuple[int, int] | None = None,
                    price_range: tuple[float, float] | None = None) -> DataFrame:
    """All given conditions at once, so that the scan can take them; none means no filter."""
    if makes:
        df = df.where(F.col("make").isin(*makes))
    if year_range:
        df = df.where(F.col("year").between(*year_range))
    if price_range:
        df = df.where(F.col("price").between(*price_range))
    return df


def matched_count(df: DataFrame, **conditions) -> DataFrame:
    """Rows matching :func:`filter_listings` next to the number of all rows."""
    matched = filter_listings(df, **conditions).agg(F.count(F.lit(1)).alias("n"))
    total = scalar_row(df.agg(F.count(F.lit(1)).alias("n")))
    return matched.select(F.col("n").alias("matched"), total["n"].alias("total"))


def distinct_before_after(df: DataFrame, col: str) -> DataFrame:
    """Every spelling with its count before and after stripping blanks.

    The stripped counts come from the raw ones, so the data is read once.
    """
    raw = df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("value")).agg(
        F.count(F.lit(1)).alias("n")
    )
    both = raw.select("value", F.col("n").alias("raw_count"), F.lit(0).alias("clean_count")).unionByName(
        raw.select(stripped(F.col("value")).alias("value"), F.lit(0).alias("raw_count"),
                   F.col("n").alias("clean_count"))
    )
    return both.groupBy("value").agg(
        F.sum("raw_count").alias("raw_count"), F.sum("clean_count").alias("clean_count")
    )


def distinct_totals(df: DataFrame, col: str) -> DataFrame:
    """Number of distinct values before and after stripping blanks."""
    found = distinct_before_after(df, col)
    return found.agg(
        F.count_if(F.col("raw_count") > 0).alias("raw_distinct"),
        F.count_if(F.col("clean_count") > 0).alias("clean_distinct"),
    )


def cardinality_report(df: DataFrame, cols: Sequence[str] = V.CATEGORICAL_FEATURES,
                       approximate: bool = False) -> DataFrame:
    """Distinct values per categorical column."""
    if approximate:
        row = df.agg(*[F.approx_count_distinct(c).alias(c) for c in cols])
        return long_form(row, list(cols), value="unique_values", cast="bigint")
    return _melted_counts(df, cols).groupBy("column").agg(F.count("value").alias("unique_values"))
