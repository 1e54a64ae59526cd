"""Distributions, outliers and ordering."""

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forecourt.functions.numeric import known, percent, ratio, scalar_row
from forecourt.operators.lookup import lookup_join
from forecourt.operators.profile import value_counts
from forecourt.operators.quantiles import quantiles

_QUARTILES = {"q1": 0.25, "q3": 0.75}
_BOX = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def iqr_bounds(df: DataFrame, col: str, k: float = 1.5, clamp: bool = True) -> DataFrame:
    """One row: quartiles, their distance and the outlier fences.

    ``clamp`` keeps the lower fence at or above zero.
    """
    spread = F.col("q3") - F.col("q1")
    lower = F.col("q1") - k * spread
    if clamp:
        lower = F.greatest(F.lit(0.0), lower)
    return quantiles(df, col, _QUARTILES).select(
        "q1", "q3", spread.alias("iqr"), lower.alias("lower"), (F.col("q3") + k * spread).alias("upper")
    )


def iqr_outliers(df: DataFrame, col: str, k: float = 1.5, clamp: bool = True,
                 side: str = "both") -> DataFrame:
    """Rows beyond the fences. The fences reach the filter as two scalars."""
    fences = scalar_row(iqr_bounds(df, col, k, clamp))
    value = known(F.col(col))
    above = value > fences["upper"]
    if side == "upper":
        return df.where(above)
    if side != "both":
        raise ValueError(f"unknown side {side!r}")
    return df.where(above | (value < fences["lower"]))


def outlier_summary(df: DataFrame, col: str, k: float = 1.5, clamp: bool = True) -> DataFrame:
    """Outliers in all and above, their share, and the range of the upper ones: one scan."""
    fences = scalar_row(iqr_bounds(df, col, k, clamp))
    value = known(F.col(col))
    above = value > fences["upper"]
    row = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        F.count_if(above | (value < fences["lower"])).alias("n_outliers"),
        F.count_if(above).alias("n_upper"),
        F.min(F.when(above, F.col(col))).alias("min_upper"),
        F.max(F.when(above, F.col(col))).alias("max_upper"),
    )
    return row.select(
        "n_outliers", "n_upper", percent(F.col("n_outliers"), F.col("_rows")).alias("outlier_pct"),
        "min_upper", "max_upper",
    )


def outlier_composition(df: DataFrame, col: str, by: str, n: int | None = 10) -> DataFrame:
    """The groups that most upper outliers belong to."""
    return value_counts(iqr_outliers(df, col, side="upper"), by, n)


def price_stats(df: DataFrame, col: str = "price", k: float = 1.5) -> DataFrame:
    """One row of price statistics. Outliers are counted against the unclamped fence."""
    quartiles = scalar_row(quantiles(df, col, _BOX))
    q1, q3 = quartiles["q1"], quartiles["q3"]
    iqr = q3 - q1
    value = known(F.col(col))
    n = F.col("n")
    adjusted = F.sqrt(n * (n - 1)) / F.when(n > 2, n - 2)
    row = df.agg(
        F.count(value).alias("n"), F.min(value).alias("min"), F.max(value).alias("max"),
        F.avg(value).alias("mean"), F.skewness(value).alias("skew"),
        F.count_if((value < q1 - k * iqr) | (value > q3 + k * iqr)).alias("n_outliers"),
    )
    return row.select(
        "min", "max", quartiles["median"].alias("median"), "mean", q1.alias("q1"), q3.alias("q3"),
        iqr.alias("iqr"), (F.col("skew") * adjusted).alias("skewness"),
        F.greatest(F.lit(0.0), q1 - k * iqr).alias("outlier_lower_bound"),
        (q3 + k * iqr).alias("outlier_upper_bound"), "n_outliers",
    )


def histogram(df: DataFrame, col: str, nbins: int = 50, by: Sequence[str] = ()) -> DataFrame:
    """Row counts over equal-width bins of the whole range, optionally per group.

    The last bin includes the maximum. Empty bins are not listed.
    """
    value = known(F.col(col))
    edges = scalar_row(df.agg(F.min(value).alias("low"), F.max(value).alias("high")))
    width = (edges["high"] - edges["low"]) / nbins
    at = F.floor(F.try_divide(value - edges["low"], width))
    bin_ = F.least(F.coalesce(at, F.lit(0)), F.lit(nbins - 1)).cast("int")
    rows = df.where(value.isNotNull()).select(*by, bin_.alias("bin"))
    counts = rows.groupBy(*by, "bin").agg(F.count(F.lit(1)).alias("count"))
    return counts.select(
        *by, "bin", (edges["low"] + F.col("bin") * width).alias("bin_low"),
        (edges["low"] + (F.col("bin") + 1) * width).alias("bin_high"), "count",
    )


def box_stats(df: DataFrame, col: str, by: str | Sequence[str], k: float = 1.5) -> DataFrame:
    """Per group: quartiles, whiskers at the furthest value inside the fences, outliers, mean."""
    by = [by] if isinstance(by, str) else list(by)
    spread = k * (F.col("q3") - F.col("q1"))
    boxes = quantiles(df, col, _BOX, by).select(
        *by, "q1", "median", "q3", (F.col("q1") - spread).alias("_low"),
        (F.col("q3") + spread).alias("_high"),
    )
    rows = df.select(*by, known(F.col(col)).alias("_v")).where(F.col("_v").isNotNull())
    inside = F.col("_v").between(F.col("_low"), F.col("_high"))
    return (
        lookup_join(rows, boxes, by, "inner")
        .groupBy(*by)
        .agg(
            F.first("q1").alias("q1"), F.first("median").alias("median"), F.first("q3").alias("q3"),
            F.min(F.when(inside, F.col("_v"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("_v"))).alias("whisker_high"),
            F.count_if(~inside).alias("n_outliers"), F.avg("_v").alias("mean"),
            F.count(F.lit(1)).alias("count"),
        )
    )


def density_curve(df: DataFrame, col: str, by: str, grid: int = 100, bins: int = 512) -> DataFrame:
    """Gaussian kernel density per group on an even grid over the group's range.

    The bandwidth is Silverman's: 0.9 min(sd, IQR/1.34) n^(-1/5). Rows are first counted in
    ``bins`` equal-width bins of their group, so the work beyond one scan is
    groups x bins x grid whatever the number of rows. A group of one row or one value has no
    bandwidth: it comes back as one point at its value, with a NULL density.
    """
    value = known(F.col(col)).alias("_v")
    rows = df.select(by, value).where(F.col(by).isNotNull() & F.col("_v").isNotNull())
    moments = rows.groupBy(by).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high"),
        F.stddev_samp("_v").alias("_sd"),
    )
    iqr = (F.col("q3") - F.col("q1")) / 1.34
    scale = F.when(iqr > 0, F.least(F.col("_sd"), iqr)).otherwise(F.col("_sd"))
    every = moments.join(quantiles(rows, "_v", _QUARTILES, by), by).withColumn(
        "_h", 0.9 * scale * F.pow(F.col("_n"), F.lit(-0.2))
    )
    shape = every.where(F.col("_h") > 0).select(by, "_n", "_low", "_high", "_h")
    flat = every.where(F.coalesce(F.col("_h"), F.lit(0.0)) <= 0).select(
        by, F.lit(0).alias("point"), F.col("_low").alias("x"), F.lit(None).cast("double").alias("density")
    )
    width = (F.col("_high") - F.col("_low")) / bins
    bin_ = F.least(F.floor((F.col("_v") - F.col("_low")) / width), F.lit(bins - 1))
    binned = (
        lookup_join(rows, shape, by, "inner")
        .groupBy(by, bin_.alias("_bin"))
        .agg(F.count(F.lit(1)).alias("_c"),
             *[F.first(c).alias(c) for c in ("_n", "_low", "_high", "_h")])
        .withColumn("_x", F.col("_low") + (F.col("_bin") + 0.5) * width)
    )
    point = F.col("_low") + F.col("point") * (F.col("_high") - F.col("_low")) / (grid - 1)
    u = (point - F.col("_x")) / F.col("_h")
    weight = F.col("_c") * F.exp(-u * u / 2) / (F.col("_n") * F.col("_h") * math.sqrt(2 * math.pi))
    return (
        binned.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))))
        .groupBy(by, "point")
        .agg(F.first(point).alias("x"), F.sum(weight).alias("density"))
        .unionByName(flat)
    )


def _ranked(df: DataFrame, col: str, k: int, order, key: str) -> DataFrame:
    # The window sees the k rows that are left, never the table.
    best = df.where(F.col(col).isNotNull() & ~F.isnan(F.col(col).cast("double"))).orderBy(order, F.col(key)).limit(k)
    rank = F.row_number().over(Window.orderBy(order, F.col(key)))
    return best.withColumn("rank", rank)


def top_k(df: DataFrame, col: str, k: int, key: str = "listing_id") -> DataFrame:
    """The ``k`` rows with the largest value, ranked; ties go by ``key``."""
    return _ranked(df, col, k, F.desc(col), key)


def bottom_k(df: DataFrame, col: str, k: int, key: str = "listing_id") -> DataFrame:
    return _ranked(df, col, k, F.asc(col), key)


def max_min_ratio(df: DataFrame, col: str) -> DataFrame:
    present = F.when(known(F.col(col)).isNotNull(), F.col(col))
    return df.agg(F.min(present).alias("min"), F.max(present).alias("max")).withColumn(
        "ratio", ratio(F.col("max"), F.col("min"))
    )
