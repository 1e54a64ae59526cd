"""Grouped aggregation, top-k restriction, pivots and shares."""

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forecourt import vocabulary as V
from forecourt.functions.listing import segment
from forecourt.functions.numeric import known, long_form, percent, ratio, scalar_row
from forecourt.operators.profile import value_counts
from forecourt.operators.quantiles import median


def restrict_to_top_k(df: DataFrame, col: str, k: int) -> DataFrame:
    """Rows whose value is among the ``k`` most frequent; the semi-join side has k rows."""
    return df.join(F.broadcast(value_counts(df, col, k).select(col)), col, "left_semi")


def median_trend(df: DataFrame, x: str = "year", by: str = "make", value: str = "price",
                 k: int = 6, label: str = "make_display") -> DataFrame:
    """Median value per (x, group) for the ``k`` most frequent groups."""
    return median(restrict_to_top_k(df, by, k), value, [x, label], f"median_{value}")


def group_order_by_median(df: DataFrame, by: str, value: str = "price") -> DataFrame:
    name = f"median_{value}"
    return median(df, value, by, name).orderBy(F.desc(name), by)


def median_pivot(df: DataFrame, rows: str = "make_display", cols: str = "body_type",
                 value: str = "price", k_rows: int = 10, k_cols: int = 6) -> DataFrame:
    """Median matrix of the most frequent rows by the most frequent columns.

    Rows come in order of frequency, columns too; a pair that does not occur is NULL. The
    ``k_cols`` names are read first because a pivot needs them in its plan.
    """
    names = [r[0] for r in value_counts(df, cols, k_cols).collect()]
    top = value_counts(df, rows, k_rows)
    ranked = top.select(
        rows, F.row_number().over(Window.orderBy(F.desc("count"), F.col(rows))).alias("rank")
    )
    kept = df.where(F.col(cols).isin(*names)).join(F.broadcast(top.select(rows)), rows, "left_semi")
    cells = median(kept, value, [rows, cols], "_m").groupBy(rows).pivot(cols, names).agg(F.first("_m"))
    return ranked.join(cells, rows, "left").select("rank", rows, *names).orderBy("rank")


def hierarchy_counts(df: DataFrame, path: Sequence[str], within: Mapping[str, Sequence[str]] = {}
                     ) -> DataFrame:
    """Sizes along a path of columns; a parent is the sum of its children.

    ``level`` is the depth, 1 for the first column. The rollup runs over leaf counts, so
    rows are not multiplied.
    """
    for column, values in within.items():
        df = filter_values(df, column, values)
    path = list(path)
    for column in path:
        df = df.where(F.col(column).isNotNull())
    leaves = df.groupBy(*path).agg(F.count(F.lit(1)).alias("_n"))
    depth = F.lit(len(path)) - sum((F.grouping(c).cast("int") for c in path), F.lit(0))
    return (
        leaves.rollup(*path)
        .agg(F.sum("_n").alias("count"), depth.alias("level"))
        .where(F.col("level") > 0)
        .select(*path, "level", "count")
    )


def with_segment(df: DataFrame) -> DataFrame:
    return df.withColumn("segment", segment(F.col("is_luxury")))


def segment_summary(engineered: DataFrame) -> DataFrame:
    """Luxury against mass market: size, share, mean and median price, other means."""
    rows = with_segment(engineered)
    means = rows.groupBy("segment").agg(
        F.count("price").alias("count"), F.avg("price").alias("mean_price"),
        F.avg("mileage").alias("mean_mileage"), F.avg("year").alias("mean_year"),
        F.avg("cylinders").alias("avg_cylinders"), F.count(F.lit(1)).alias("_rows"),
    )
    total = scalar_row(engineered.agg(F.count(F.lit(1)).alias("rows")))
    return means.join(median(rows, "price", "segment", "median_price"), "segment", "left").select(
        "segment", "count", percent(F.col("_rows"), total["rows"]).alias("share_pct"),
        "mean_price", "median_price", "mean_mileage", "mean_year", "avg_cylinders",
    )


def segment_ratios(engineered: DataFrame) -> DataFrame:
    """Luxury over mass market for price and cylinders, and both shares of the market."""
    summary = segment_summary(engineered)

    def of(name: str, column: str):
        return F.max(F.when(F.col("segment") == name, F.col(column)))

    lux, mass = V.LUXURY_SEGMENT, V.MASS_SEGMENT
    return summary.agg(
        *[ratio(of(lux, c), of(mass, c)).alias(f"{c}_ratio")
          for c in ("mean_price", "median_price", "avg_cylinders")],
        of(lux, "share_pct").alias("luxury_share_pct"),
        of(mass, "share_pct").alias("mass_share_pct"),
        F.floor(ratio(of(mass, "count"), of(lux, "count"))).cast("bigint").alias("mass_per_luxury"),
    )


def feature_penetration(engineered: DataFrame) -> DataFrame:
    """Share of each segment's listings with an amenity, and the difference in points."""
    flags = list(V.AMENITY_FLAGS)
    luxury = F.col("is_luxury") == 1

    def share(flag, mine):
        return F.avg(F.when(mine, F.col(flag)))

    row = engineered.agg(*[
        F.struct(share(c, luxury).alias("lux"), share(c, ~luxury).alias("mass")).alias(c)
        for c in flags
    ])
    entries = F.array(*[
        F.struct(F.lit(a).alias("amenity"), (100 * F.col(f"{c}.lux")).alias("luxury_pct"),
                 (100 * F.col(f"{c}.mass")).alias("mass_pct"))
        for a, c in zip(V.AMENITIES, flags)
    ])
    return row.select(F.inline(entries)).withColumn(
        "difference", F.col("luxury_pct") - F.col("mass_pct")
    )


def top_k_per_group(df: DataFrame, group: str, col: str, k: int) -> DataFrame:
    """The ``k`` most frequent values of ``col`` in each group, ranked.

    Ranking runs over the (group, value) counts, cut to k per partition before it shuffles.
    """
    counts = (
        df.where(F.col(group).isNotNull() & F.col(col).isNotNull())
        .groupBy(group, col)
        .agg(F.count(F.lit(1)).alias("count"))
    )
    order = Window.partitionBy(group).orderBy(F.desc("count"), F.col(col))
    return counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def share_within_group(df: DataFrame, outer: str, inner: str, k_inner: int | None = None,
                       outer_values: Sequence[str] = ()) -> DataFrame:
    """Percentage of each inner value among the kept rows of its outer group.

    The inner restriction is to the most frequent values of the whole table; both
    restrictions apply before the denominators are taken.
    """
    kept = df if k_inner is None else restrict_to_top_k(df, inner, k_inner)
    if outer_values:
        kept = filter_values(kept, outer, outer_values)
    counts = (
        kept.where(F.col(outer).isNotNull() & F.col(inner).isNotNull())
        .groupBy(outer, inner)
        .agg(F.count(F.lit(1)).alias("count"))
    )
    whole = counts.groupBy(outer).agg(F.sum("count").alias("_whole"))
    return counts.join(whole, outer).select(
        outer, inner, "count", percent(F.col("count"), F.col("_whole")).alias("pct")
    )


def reindexed_group_stat(df: DataFrame, by: str = "condition", value: str = "price",
                         domain: Sequence[str] = V.ORDERED_CONDITIONS) -> DataFrame:
    """Median per category in a fixed order; absent ones stay, unlisted ones go."""
    positions = df.sparkSession.createDataFrame(
        [(i, c) for i, c in enumerate(domain)], f"position int, {by} string"
    )
    name = f"median_{value}"
    medians = median(filter_values(df, by, domain), value, by, name)
    return positions.join(medians, by, "left").select("position", by, name).orderBy("position")


def group_mean(df: DataFrame, by: str = "feature_count", value: str = "price") -> DataFrame:
    return (
        df.where(F.col(by).isNotNull()).groupBy(by).agg(F.avg(known(F.col(value))).alias(f"mean_{value}"))
    )


def filter_values(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    return df.where(F.col(col).isin(*values))


def union_labelled(parts: Mapping[str, DataFrame], label: str = "label") -> DataFrame:
    """The tables on top of each other, each tagged with its name."""
    tagged = [df.withColumn(label, F.lit(name)) for name, df in parts.items()]
    result = tagged[0]
    for more in tagged[1:]:
        result = result.unionByName(more)
    return result
