"""Profiling, distributions, grouping, correlation."""

from pyspark.sql import functions as F

from checks import base as B
from forecourt import vocabulary as V
from forecourt.operators import correlation as R
from forecourt.operators import distribution as D
from forecourt.operators import grouping as G
from forecourt.operators import profile as P
from forecourt.operators import quantiles as Q

CATEGORICAL = list(V.CATEGORICAL_FEATURES)
NUMERIC = ["year", "price", "mileage"]
MAKES = ["brand-4", "brand-7", "brand-12"]
NATIONS = ["NATION_1", "NATION_5", "NATION_9"]
CORRELATED = ["price", "year", "mileage", "cylinders", "car_age", "mileage_per_year",
              "condition_score", "feature_count", "is_luxury", "log_price"]
TARGETED = [*V.NUMERIC_FEATURES]


def _compact(df):
    """Some columns that exercise every kind of value, for the all-column reports."""
    return df.select("make", "model", "year", "price", "mileage", "body_type", "cylinders",
                     "transmission", "fuel_type", "color", "location", "description")


def raw(f):
    return lambda s, d: f(B.raw(s, d))


def clean(f, keep=None):
    """A query over the clean listings; over a stored copy of the columns ``keep`` if it scans them more than once."""
    if keep:
        return lambda s, d: f(B.kept(B.clean, s, d, keep))
    return lambda s, d: f(B.clean(s, d))


def eng(f, digits=6):
    return lambda s, d: B.rounded(f(B.engineered(s, d)), digits)


def _labelled_counts(e):
    parts = {
        name: P.value_counts(G.with_segment(e).where(F.col("segment") == name), "body_type", 5)
        for name in (V.LUXURY_SEGMENT, V.MASS_SEGMENT)
    }
    return G.union_labelled(parts, "segment")


QUERIES = {
    # profiling
    "column_profile": raw(lambda r: P.column_profile(_compact(r))),
    "describe_numeric": raw(lambda r: P.describe_numeric(r, NUMERIC)),
    "categorical_profile": raw(lambda r: P.categorical_profile(r, [*CATEGORICAL, "model", "cylinders"])),
    "missing_report": raw(lambda r: P.missing_report(P.filter_listings(r))),
    "sentinel_report": raw(lambda r: P.sentinel_report(r, {"cylinders": "Unknown", "model": "other"})),
    "value_counts": clean(lambda c: P.value_counts(c, "make_display", 20)),
    "value_counts_by_value": clean(lambda c: P.value_counts(c, "year", sort="value")),
    "value_counts_cylinders": raw(lambda r: P.value_counts(r, "cylinders")),
    "value_counts_feature_count": eng(lambda e: P.value_counts(e, "feature_count", sort="value")),
    "value_shares": lambda s, d: B.rounded(P.value_shares(B.clean(s, d), "condition")),
    "feature_frequency": eng(P.feature_frequency),
    "filter_listings": raw(lambda r: P.filter_listings(r, MAKES, (2020, 2023), (20000, 80000))),
    "matched_count": raw(lambda r: P.matched_count(
        r, makes=MAKES, year_range=(2020, 2023), price_range=(20000, 80000))),
    "distinct_before_after": raw(lambda r: P.distinct_before_after(r, "location")),
    "distinct_totals": raw(lambda r: P.distinct_totals(r, "location")),
    "cardinality_report": clean(lambda c: P.cardinality_report(c, [*CATEGORICAL, "model"])),
    # distributions
    "quantiles": raw(lambda r: B.rounded(Q.quantiles(r, "price", {"p10": .1, "q1": .25, "median": .5, "q3": .75, "p99": .99}))),
    "quantiles_by_make": raw(lambda r: B.rounded(Q.quantiles(r, "price", {"q1": .25, "median": .5, "q3": .75}, "make"))),
    "iqr_bounds": raw(lambda r: B.rounded(D.iqr_bounds(r, "price"))),
    "iqr_outliers": raw(lambda r: D.iqr_outliers(r, "price").select("listing_id", "price")),
    "outlier_summary": raw(lambda r: B.rounded(D.outlier_summary(r, "price"))),
    "outlier_composition_make": clean(lambda c: D.outlier_composition(c, "price", "make_display")),
    "outlier_composition_body": clean(lambda c: D.outlier_composition(c, "price", "body_type", None)),
    "price_stats": raw(lambda r: B.rounded(D.price_stats(r), 4)),
    "histogram_price": raw(lambda r: B.rounded(D.histogram(r, "price", 80))),
    "histogram_log_price": eng(lambda e: D.histogram(e, "log_price", 60).select("bin", "count")),
    "histogram_by_group": eng(lambda e: D.histogram(e, "car_age", 20, ["is_luxury"])),
    "box_stats_make": clean(lambda c: B.rounded(D.box_stats(G.restrict_to_top_k(c, "make_display", 15), "price", "make_display"))),
    "box_stats_cylinders": clean(lambda c: B.rounded(D.box_stats(c, "price", "cylinders")), ["price", "cylinders"]),
    "density_curve": raw(lambda r: B.rounded(D.density_curve(r, "price", "body_type").withColumn("density", 1e6 * F.col("density")), 4)),
    "top_k": clean(lambda c: D.top_k(c, "price", 10).select(
        "rank", "listing_id", "make_display", "model_display", "year", "price", "mileage", "body_type", "cylinders", "location")),
    "bottom_k": clean(lambda c: D.bottom_k(c, "price", 10).select("rank", "listing_id", "price")),
    "max_min_ratio": raw(lambda r: B.rounded(D.max_min_ratio(r, "price"))),
    # grouping
    "restrict_to_top_k": raw(lambda r: G.restrict_to_top_k(r, "body_type", 4).select("listing_id", "body_type")),
    "median_trend": clean(lambda c: B.rounded(G.median_trend(c))),
    "group_order_by_median": clean(lambda c: B.rounded(G.group_order_by_median(c, "body_type"))),
    "median_pivot": clean(lambda c: B.rounded(G.median_pivot(c))),
    "hierarchy_counts": clean(lambda c: G.hierarchy_counts(
        c, ["location", "body_type", "fuel_type"], {"location": NATIONS})),
    "segment_summary": eng(G.segment_summary),
    "segment_ratios": eng(G.segment_ratios),
    "feature_penetration": eng(G.feature_penetration),
    "top_k_per_group": eng(lambda e: G.top_k_per_group(G.with_segment(e), "segment", "body_type", 5)),
    "share_within_group": clean(lambda c: B.rounded(G.share_within_group(c, "location", "color", 3, NATIONS))),
    "reindexed_group_stat": clean(lambda c: B.rounded(G.reindexed_group_stat(c))),
    "group_mean": eng(G.group_mean),
    "filter_values": clean(lambda c: G.filter_values(c, "location", NATIONS).select("listing_id", "location")),
    "union_labelled": lambda s, d: _labelled_counts(B.engineered(s, d)),
    # correlation
    "correlation_matrix": eng(lambda e: R.correlation_matrix(e, CORRELATED)),
    "correlation_with_target": eng(lambda e: R.correlation_with_target(e, TARGETED)),
}

_TYPES = {"year": "int", "price": "double", "mileage": "int"}
_PROFILED = ["make", "model", "year", "price", "mileage", "body_type", "cylinders",
             "transmission", "fuel_type", "color", "location", "description"]


def _each(columns, template):
    return " UNION ALL ".join(template.format(c=c) for c in columns)


def _profile_sql():
    # Doubles print differently in the two engines beyond 7 digits, so their samples are
    # taken from numbers that print alike; here prices have two decimals.
    parts = []
    for c in _PROFILED:
        kind = _TYPES.get(c, "string")
        parts.append(f"""
SELECT '{c}' AS "column", '{kind}' AS "type", count({c}) AS non_null, count(DISTINCT {c}) AS unique_values,
 (SELECT string_agg(v, ', ' ORDER BY v) FROM (SELECT DISTINCT CAST({c} AS VARCHAR) AS v FROM raw
   WHERE {c} IS NOT NULL ORDER BY v LIMIT 4)) AS sample_values FROM raw""")
    return B.over_raw(" UNION ALL ".join(parts))


def _half_even(expr, digits=2):
    return f"round_even(({expr}) * 1e{digits}, 0) / 1e{digits}"


def _fences(clamp=True):
    low = "q1 - 1.5 * (q3 - q1)"
    low = f"greatest(0, {low})" if clamp else low
    return (
        "b AS (SELECT q1, q3, q3 - q1 AS iqr, " + low + " AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM "
        "(SELECT quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.75) AS q3 FROM raw))"
    )


def _with_fences(sql):
    return B.over_raw(f", {_fences()} {sql}")


def _bins(table, col, n, by=""):
    w = f"((SELECT max({col}) FROM {table}) - (SELECT min({col}) FROM {table})) / {n}.0"
    low = f"(SELECT min({col}) FROM {table})"
    group = f"{by}, " if by else ""
    return (
        f"SELECT {group} bin, round({low} + bin * ({w}), 6) AS bin_low, round({low} + (bin + 1) * ({w}), 6) AS bin_high, count "
        f"FROM (SELECT {group} CAST(least(floor(({col} - {low}) / ({w})), {n - 1}) AS INT) AS bin, count(*) AS count "
        f"FROM {table} GROUP BY ALL)"
    )


def _box(table, by):
    return f""", q AS (SELECT {by}, quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.5) AS median,
 quantile_cont(price, 0.75) AS q3 FROM {table} GROUP BY {by}),
j AS (SELECT t.{by}, t.price, q1, median, q3, t.price BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside
 FROM {table} t JOIN q ON t.{by} = q.{by})
SELECT {by}, round(any_value(q1), 6) AS q1, round(any_value(median), 6) AS median, round(any_value(q3), 6) AS q3,
 round(min(price) FILTER (WHERE inside), 6) AS whisker_low, round(max(price) FILTER (WHERE inside), 6) AS whisker_high,
 count(*) FILTER (WHERE NOT inside) AS n_outliers, round(avg(price), 6) AS mean, count(*) AS count FROM j GROUP BY {by}"""


def _corr(x, y):
    return f"SELECT '{x}' AS x, '{y}' AS y, round(nullif(corr({x}, {y}), 'NaN'), 6) AS correlation FROM eng"


_LUX, _MASS = "segment = 'Luxury'", "segment = 'Mass Market'"
_BODIES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
_AMENITY_SQL = " UNION ALL ".join(
    f"""SELECT '{a}' AS amenity, round(100 * avg({c}) FILTER (WHERE {_LUX}), 6) AS luxury_pct,
 round(100 * avg({c}) FILTER (WHERE {_MASS}), 6) AS mass_pct,
 round(100 * avg({c}) FILTER (WHERE {_LUX}) - 100 * avg({c}) FILTER (WHERE {_MASS}), 6) AS difference FROM eng"""
    for a, c in zip(V.AMENITIES, V.AMENITY_FLAGS)
)
_FILTER = "make IN ('brand-4','brand-7','brand-12') AND year BETWEEN 2020 AND 2023 AND price BETWEEN 20000 AND 80000"
_NATIONS = "('NATION_1','NATION_5','NATION_9')"


def _by_luxury(expr):
    return f"max({expr}) FILTER (WHERE {_LUX}) / max({expr}) FILTER (WHERE {_MASS})"


_SEGMENTS = """s AS (SELECT segment, count(price) AS count, 100.0 * count(*) / (SELECT count(*) FROM eng) AS share_pct,
 avg(price) AS mean_price, quantile_cont(price, 0.5) AS median_price, avg(mileage) AS mean_mileage,
 avg(year) AS mean_year, avg(cylinders) AS avg_cylinders FROM eng GROUP BY segment)"""

ORACLES = {
    "column_profile": _profile_sql(),
    "describe_numeric": B.over_raw(_each(NUMERIC, (
        "SELECT '{c}' AS \"column\", count({c}) AS count, " + ", ".join([
            _half_even("avg({c})") + " AS mean", _half_even("stddev_samp({c})") + " AS std",
            _half_even("CAST(min({c}) AS DOUBLE)") + " AS min",
            _half_even("quantile_cont(CAST({c} AS DOUBLE), 0.25)") + " AS p25",
            _half_even("quantile_cont(CAST({c} AS DOUBLE), 0.5)") + " AS p50",
            _half_even("quantile_cont(CAST({c} AS DOUBLE), 0.75)") + " AS p75",
            _half_even("CAST(max({c}) AS DOUBLE)") + " AS max",
        ]) + " FROM raw"))),
    "categorical_profile": B.over_raw(_each([*CATEGORICAL, "model", "cylinders"], (
        "SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS unique_values, mode() WITHIN GROUP (ORDER BY {c}) AS most_frequent, "
        "(SELECT max(n) FROM (SELECT count(*) AS n FROM raw WHERE {c} IS NOT NULL GROUP BY {c})) AS top_frequency, "
        + _half_even("100.0 * (SELECT max(n) FROM (SELECT count(*) AS n FROM raw WHERE {c} IS NOT NULL GROUP BY {c})) / count(*)", 1)
        + " AS top_pct FROM raw"))),
    "missing_report": B.over_raw(
        "SELECT * FROM (" + _each(["listing_id", *_PROFILED], (
            "SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing_count, "
            + _half_even("100.0 * (count(*) - count({c})) / count(*)") + " AS missing_pct FROM raw"))
        + ") WHERE missing_count > 0"),
    "sentinel_report": B.over_raw(
        "SELECT 'cylinders' AS \"column\", 'Unknown' AS sentinel, count(*) FILTER (WHERE cylinders = 'Unknown') AS n FROM raw "
        "UNION ALL SELECT 'model', 'other', count(*) FILTER (WHERE model = 'other') FROM raw"),
    "value_counts": B.over_clean(
        "SELECT make_display, count(*) AS count FROM clean GROUP BY 1 ORDER BY count DESC, make_display LIMIT 20"),
    "value_counts_by_value": B.over_clean("SELECT year, count(*) AS count FROM clean GROUP BY 1 ORDER BY year"),
    "value_counts_cylinders": B.over_raw("SELECT cylinders, count(*) AS count FROM raw GROUP BY 1"),
    "value_counts_feature_count": B.over_engineered("SELECT feature_count, count(*) AS count FROM eng GROUP BY 1"),
    "value_shares": B.over_clean(
        "SELECT condition, count(*) AS count, round(100.0 * count(*) / (SELECT count(*) FROM clean), 6) AS pct FROM clean GROUP BY 1"),
    "feature_frequency": B.over_engineered(" UNION ALL ".join(
        f"SELECT '{a}' AS amenity, CAST(sum({c}) AS BIGINT) AS listings, round(100.0 * sum({c}) / count(*), 6) AS pct FROM eng"
        for a, c in zip(V.AMENITIES, V.AMENITY_FLAGS))),
    "filter_listings": B.over_raw(f"SELECT * FROM raw WHERE {_FILTER}"),
    "matched_count": B.over_raw(f"SELECT count(*) FILTER (WHERE {_FILTER}) AS matched, count(*) AS total FROM raw"),
    "distinct_before_after": B.over_raw(
        f", a AS (SELECT location AS value, count(*) AS n FROM raw GROUP BY 1), "
        f"b AS (SELECT {B.STRIP.format('location')} AS value, count(*) AS n FROM raw GROUP BY 1) "
        "SELECT coalesce(a.value, b.value) AS value, coalesce(a.n, 0) AS raw_count, coalesce(b.n, 0) AS clean_count "
        "FROM a FULL JOIN b ON a.value = b.value"),
    "distinct_totals": B.over_raw(
        f"SELECT count(DISTINCT location) AS raw_distinct, count(DISTINCT {B.STRIP.format('location')}) AS clean_distinct FROM raw"),
    "cardinality_report": B.over_clean(_each(
        [*CATEGORICAL, "model"], "SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS unique_values FROM clean")),
    "quantiles": B.over_raw("SELECT " + ", ".join(
        f"round(quantile_cont(price, {p}), 6) AS {n}"
        for n, p in (("p10", .1), ("q1", .25), ("median", .5), ("q3", .75), ("p99", .99))) + " FROM raw"),
    "quantiles_by_make": B.over_raw("SELECT make, " + ", ".join(
        f"round(quantile_cont(price, {p}), 6) AS {n}" for n, p in (("q1", .25), ("median", .5), ("q3", .75)))
        + " FROM raw GROUP BY make"),
    "iqr_bounds": _with_fences(
        "SELECT round(q1, 6) AS q1, round(q3, 6) AS q3, round(iqr, 6) AS iqr, round(lower, 6) AS lower, round(upper, 6) AS upper FROM b"),
    "iqr_outliers": _with_fences(
        "SELECT listing_id, price FROM raw, b WHERE price < lower OR price > upper"),
    "outlier_summary": _with_fences(
        "SELECT count(*) FILTER (WHERE price < lower OR price > upper) AS n_outliers, "
        "count(*) FILTER (WHERE price > upper) AS n_upper, "
        "round(100.0 * count(*) FILTER (WHERE price < lower OR price > upper) / count(*), 6) AS outlier_pct, "
        "round(min(price) FILTER (WHERE price > upper), 6) AS min_upper, "
        "round(max(price) FILTER (WHERE price > upper), 6) AS max_upper FROM raw, b"),
    "outlier_composition_make": B.over_clean(
        f", {_fences()} SELECT make_display, count(*) AS count FROM clean, b WHERE price > upper GROUP BY 1 "
        "ORDER BY count DESC, make_display LIMIT 10"),
    "outlier_composition_body": B.over_clean(
        f", {_fences()} SELECT body_type, count(*) AS count FROM clean, b WHERE price > upper GROUP BY 1"),
    "price_stats": B.over_raw(
        f", {_fences(False)} SELECT round(min(price), 4) AS min, round(max(price), 4) AS max, "
        "round(quantile_cont(price, 0.5), 4) AS median, round(avg(price), 4) AS mean, round(any_value(q1), 4) AS q1, "
        "round(any_value(q3), 4) AS q3, round(any_value(iqr), 4) AS iqr, round(skewness(price), 4) AS skewness, "
        "round(greatest(0, any_value(lower)), 4) AS outlier_lower_bound, round(any_value(upper), 4) AS outlier_upper_bound, "
        "count(*) FILTER (WHERE price < lower OR price > upper) AS n_outliers FROM raw, b"),
    "histogram_price": B.over_raw(_bins("raw", "price", 80)),
    "histogram_log_price": B.over_engineered(f"SELECT bin, count FROM ({_bins('eng', 'log_price', 60)})"),
    "histogram_by_group": B.over_engineered(_bins("eng", "car_age", 20, "is_luxury")),
    "box_stats_make": B.over_clean(
        ", t AS (SELECT * FROM clean WHERE make_display IN (SELECT make_display FROM clean GROUP BY 1 "
        "ORDER BY count(*) DESC, make_display LIMIT 15))" + _box("t", "make_display")),
    "box_stats_cylinders": B.over_clean(_box("clean", "cylinders")),
    "density_curve": B.over_raw(""", m AS (SELECT body_type, count(*) AS n, min(price) AS low, max(price) AS high,
 0.9 * least(stddev_samp(price), (quantile_cont(price, 0.75) - quantile_cont(price, 0.25)) / 1.34) * pow(count(*), -0.2) AS h
 FROM raw GROUP BY body_type),
bins AS (SELECT r.body_type, least(floor((price - low) / ((high - low) / 512)), 511) AS bin, count(*) AS c
 FROM raw r JOIN m ON r.body_type = m.body_type GROUP BY ALL),
pts AS (SELECT m.body_type, n, h, c, CAST(point AS INT) AS point, low + point * (high - low) / 99 AS x,
 low + (bin + 0.5) * ((high - low) / 512) AS center
 FROM m JOIN bins ON m.body_type = bins.body_type, range(100) AS g(point))
SELECT body_type, point, round(any_value(x), 4) AS x,
 round(1e6 * sum(c * exp(-((x - center) / h) * ((x - center) / h) / 2) / (n * h * sqrt(2 * pi()))), 4) AS density
 FROM pts GROUP BY body_type, point"""),
    "top_k": B.over_clean(
        "SELECT CAST(row_number() OVER (ORDER BY price DESC, listing_id) AS INT) AS rank, listing_id, make_display, model_display, "
        "year, price, mileage, body_type, cylinders, location FROM clean ORDER BY price DESC, listing_id LIMIT 10"),
    "bottom_k": B.over_clean(
        "SELECT CAST(row_number() OVER (ORDER BY price, listing_id) AS INT) AS rank, listing_id, price FROM clean ORDER BY price, listing_id LIMIT 10"),
    "max_min_ratio": B.over_raw(
        "SELECT round(min(price), 6) AS min, round(max(price), 6) AS max, round(max(price) / min(price), 6) AS ratio FROM raw"),
    "restrict_to_top_k": B.over_raw(
        "SELECT listing_id, body_type FROM raw WHERE body_type IN (SELECT body_type FROM raw GROUP BY 1 "
        "ORDER BY count(*) DESC, body_type LIMIT 4)"),
    "median_trend": B.over_clean(
        "SELECT year, make_display, round(quantile_cont(price, 0.5), 6) AS median_price FROM clean WHERE make IN "
        "(SELECT make FROM clean GROUP BY 1 ORDER BY count(*) DESC, make LIMIT 6) GROUP BY 1, 2"),
    "group_order_by_median": B.over_clean(
        "SELECT body_type, round(quantile_cont(price, 0.5), 6) AS median_price FROM clean GROUP BY 1 ORDER BY 2 DESC"),
    "median_pivot": B.over_clean(
        ", top AS (SELECT make_display, CAST(row_number() OVER (ORDER BY count(*) DESC, make_display) AS INT) AS rank "
        "FROM clean GROUP BY 1 ORDER BY rank LIMIT 10) SELECT rank, top.make_display, " + ", ".join(
            f"round(quantile_cont(price, 0.5) FILTER (WHERE body_type = '{b}'), 6) AS \"{b}\"" for b in _BODIES)
        + " FROM top LEFT JOIN clean USING (make_display) GROUP BY 1, 2"),
    "hierarchy_counts": B.over_clean(
        "SELECT location, body_type, fuel_type, CAST(3 - grouping(location) - grouping(body_type) - grouping(fuel_type) AS INT) AS level, "
        f"count(*) AS count FROM clean WHERE location IN {_NATIONS} GROUP BY ROLLUP (location, body_type, fuel_type) "
        "HAVING grouping(location) = 0"),
    "segment_summary": B.over_engineered(
        f", {_SEGMENTS} SELECT segment, count, round(share_pct, 6) AS share_pct, round(mean_price, 6) AS mean_price, "
        "round(median_price, 6) AS median_price, round(mean_mileage, 6) AS mean_mileage, round(mean_year, 6) AS mean_year, "
        "round(avg_cylinders, 6) AS avg_cylinders FROM s"),
    "segment_ratios": B.over_engineered(
        f", {_SEGMENTS} SELECT " + ", ".join(
            f"round({_by_luxury(c)}, 6) AS {c}_ratio" for c in ("mean_price", "median_price", "avg_cylinders"))
        + f", round(max(share_pct) FILTER (WHERE {_LUX}), 6) AS luxury_share_pct, "
        f"round(max(share_pct) FILTER (WHERE {_MASS}), 6) AS mass_share_pct, "
        f"max(count) FILTER (WHERE {_MASS}) // max(count) FILTER (WHERE {_LUX}) AS mass_per_luxury FROM s"),
    "feature_penetration": B.over_engineered(_AMENITY_SQL),
    "top_k_per_group": B.over_engineered(
        "SELECT segment, body_type, count, rank FROM (SELECT segment, body_type, count(*) AS count, "
        "CAST(row_number() OVER (PARTITION BY segment ORDER BY count(*) DESC, body_type) AS INT) AS rank FROM eng GROUP BY 1, 2) WHERE rank <= 5"),
    "share_within_group": B.over_clean(
        ", k AS (SELECT * FROM clean WHERE color IN (SELECT color FROM clean GROUP BY 1 ORDER BY count(*) DESC, color LIMIT 3) "
        f"AND location IN {_NATIONS}) SELECT location, color, count(*) AS count, "
        "round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY location), 6) AS pct FROM k GROUP BY 1, 2"),
    "reindexed_group_stat": B.over_clean(
        ", o AS (SELECT * FROM (VALUES " + ", ".join(f"({i}, '{c}')" for i, c in enumerate(V.ORDERED_CONDITIONS))
        + ") AS t(position, condition)) SELECT position, o.condition, round(quantile_cont(price, 0.5), 6) AS median_price "
        "FROM o LEFT JOIN clean c ON o.condition = c.condition GROUP BY 1, 2"),
    "group_mean": B.over_engineered(
        "SELECT feature_count, round(avg(price), 6) AS mean_price FROM eng GROUP BY 1"),
    "filter_values": B.over_clean(f"SELECT listing_id, location FROM clean WHERE location IN {_NATIONS}"),
    "union_labelled": B.over_engineered(" UNION ALL ".join(
        f"(SELECT body_type, count(*) AS count, '{s}' AS segment FROM eng WHERE segment = '{s}' GROUP BY 1 "
        "ORDER BY count DESC, body_type LIMIT 5)" for s in ("Luxury", "Mass Market"))),
    "correlation_matrix": B.over_engineered(
        " UNION ALL ".join(_corr(x, y) for x in CORRELATED for y in CORRELATED)),
    "correlation_with_target": B.over_engineered(" UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", round(nullif(corr({c}, price), 'NaN'), 6) AS correlation FROM eng" for c in TARGETED)),
}
