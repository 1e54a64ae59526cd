"""Comparables, deals, configuration rules, segments of candidates, and the catalog."""

from pyspark.sql import functions as F

from checks import base as B
from checks.modelling import CENTERS, MODELLED, POINTS, SHARE, partly_missing
from forecourt import schema as S
from forecourt.operators import anomaly as A
from forecourt.operators import catalog as C
from forecourt.operators import regress as L
from forecourt.operators import scoring as X
from forecourt.operators import segment as U
from forecourt.operators.lookup import lookup_join
from forecourt.operators.prep import Scaler
from forecourt.operators.quantiles import median
from forecourt.sources.tables import ECONOMY_MAKES, LUXURY_MAKES
from forecourt.streaming.candidates import write_rated

_BOX = ("q1", "median", "q3", "whisker_low", "whisker_high", "mean")


def candidates(clean):
    """Every listing as a candidate: structured columns plus the price asked for."""
    return clean.withColumn("listed_price", F.col("price")).drop("price", "description")


def query(f, digits=6):
    return lambda s, d: B.rounded(f(B.clean(s, d)), digits)


def engineered(f, digits=6, keep=None):
    if keep:
        return lambda s, d: B.rounded(f(B.kept(B.engineered, s, d, keep)), digits)
    return lambda s, d: B.rounded(f(B.engineered(s, d)), digits)


def _features(c):
    found = X.candidate_features(candidates(c), LUXURY_MAKES)
    return found.select("listing_id", "car_age", "mileage_per_year", "log_mileage", "condition_score",
                        "feature_count", "is_luxury", "has_sunroof", "has_bluetooth")


def _comparables(c):
    return X.comparables_stats(candidates(c), c).select(
        "listing_id", "n_comparables", "min_price", "median_price", "max_price")


def _by_body(c):
    return X.comparables_by_body(candidates(c), c).select(
        "listing_id", "n_comparables", "n_outliers", *_BOX)


def _streamed(c):
    """The candidates as a stream of files, joined to the index and written by the stream."""
    places = [B.scratch(c.sparkSession) for _ in range(3)]
    wanted = candidates(c).select("listing_id", "make", "body_type", "year")
    wanted.write.parquet(places[0])
    stream = c.sparkSession.readStream.schema(wanted.schema).parquet(places[0])
    found = X.comparables_by_body(stream, c).select("listing_id", "n_comparables", "n_outliers", *_BOX)
    write_rated(found, places[1], places[2], once=True).awaitTermination()
    return c.sparkSession.read.parquet(places[1]).drop("rated_at")


def _rated(c):
    guesses = lookup_join(candidates(c), median(c, "price", "make", "predicted_price"), "make")
    return X.rate_deal(guesses).select("listing_id", "price_diff", "price_diff_pct", "deal_rating")


def _validated(c):
    odd = candidates(c).withColumn("cylinders", (F.col("cylinders") + F.col("year") % 4 * 2 - 3).cast("int"))
    checked = X.validate_configuration(odd, c, 3, LUXURY_MAKES, ECONOMY_MAKES)
    return checked.select("listing_id", F.array_join("broken_rules", "|").alias("broken_rules"), "is_plausible")


def _price_model(e):
    return L.train_regression(e, ["Linear Regression"]).models["Linear Regression"]


def _predicted(e):
    return L.predict_price(e, _price_model(e)).select("listing_id", "predicted_price")


def _constant_model(e):
    """A penalty that leaves no coefficient: the mean of the train split's label."""
    return L.train_regression(e, ["Lasso Regression"]).models["Lasso Regression"]


def _rated_in_part(c):
    asked = partly_missing(candidates(c), "listed_price")
    guesses = lookup_join(asked, median(c, "price", "make", "predicted_price"), "make")
    return X.rate_deal(guesses).select("listing_id", "price_diff", "price_diff_pct", "deal_rating")


#: Two small trees over price and mileage: tree, node, feature (-1: leaf), threshold, left, right, path.
_TREES = [
    (0, 0, 0, 60000.0, 1, 2, 0.0), (0, 1, -1, 0.0, 1, 1, 12.0), (0, 2, 1, 150000.0, 3, 4, 0.0),
    (0, 3, -1, 0.0, 3, 3, 9.5), (0, 4, -1, 0.0, 4, 4, 2.0),
    (1, 0, 1, 30000.0, 1, 2, 0.0), (1, 1, -1, 0.0, 1, 1, 5.0), (1, 2, -1, 0.0, 2, 2, 14.0),
]


def _fixed_forest(e):
    nodes = e.sparkSession.createDataFrame(_TREES, S.ISOLATION_NODES)
    forest = A.IsolationForest(nodes, ["price", "mileage"], A.SAMPLE, -0.5)
    asked = partly_missing(e.withColumn("listed_price", F.col("price")), "listed_price")
    return X.flag_deal_anomaly(asked, forest).select("listing_id", "anomaly_score", "is_anomaly")


def _fixed_segments(e):
    """Segments, plane and profiles given; only the prediction is fitted."""
    unscaled = lambda *cols: Scaler(dict.fromkeys(cols, 0.0), dict.fromkeys(cols, 1.0))
    segments = U.SegmentModel(unscaled("price", "mileage"), CENTERS, None, len(CENTERS))
    plane = U.Projection(unscaled("cylinders", "car_age"), [[0.5, 0.25], [-1.0, 0.125]], [])
    profiles = e.sparkSession.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "cluster int, segment_name string")
    placed = X.assign_segment(e.drop("price"), _constant_model(e), segments, plane, profiles)
    return placed.select("listing_id", "predicted_price", "cluster", "segment_name", "pc1", "pc2")


def _deal_anomalies(e):
    forest = A.fit_isolation_forest(e)
    asked = e.withColumn("listed_price", F.col("price") * 1.2)
    return X.flag_deal_anomaly(asked, forest).select("listing_id", "anomaly_score", "is_anomaly")


def _segments(e):
    segments = U.kmeans_sweep(e)
    clustered = U.assign_cluster(e, segments.scaler.means, segments.centers, segments.scaler)
    profiles = U.name_segments(U.cluster_profiles(clustered))
    placed = X.assign_segment(e.drop("price"), _price_model(e), segments, U.fit_projection(e), profiles)
    return placed.select("listing_id", "predicted_price", "cluster", "segment_name", "pc1", "pc2")


def _listed(df, column="valid_cylinders"):
    return df.withColumn(column, F.array_join(column, ","))


QUERIES = {
    "candidate_features": query(_features),
    "predict_price": engineered(_predicted, keep=MODELLED),
    "comparables_stats": query(_comparables),
    "comparables_by_body": query(_by_body),
    "comparables_index": query(X.comparables_index),
    "comparables_on_stream": query(_streamed),
    "rate_deal": query(_rated),
    "predict_price_constant": engineered(lambda e: L.predict_price(e, _constant_model(e)).select("listing_id", "predicted_price"), keep=MODELLED),
    "rate_deal_missing": query(_rated_in_part),
    "flag_deal_anomaly_fixed": engineered(_fixed_forest),
    "assign_segment_fixed": engineered(_fixed_segments, keep=MODELLED),
    "flag_deal_anomaly": engineered(_deal_anomalies, keep=POINTS),
    "valid_values_body": query(lambda c: _listed(C.valid_values_top_k(c, "body_type"))),
    "valid_values_make": query(lambda c: _listed(C.valid_values_top_k(c, "make"))),
    "validate_configuration": query(_validated),
    "assign_segment": engineered(_segments, keep=MODELLED),
    "catalog": query(C.catalog),
    "year_range": query(C.year_range),
    "models_by_make": query(C.models_by_make),
    "table_shape": query(C.table_shape),
}


def _valid(by, k=4, name=None):
    return f"""SELECT {by}, string_agg(CAST(cylinders AS VARCHAR), ',' ORDER BY r) AS {name or 'valid_cylinders'} FROM
 (SELECT {by}, cylinders, row_number() OVER (PARTITION BY {by} ORDER BY count(*) DESC, cylinders) AS r FROM clean GROUP BY {by}, cylinders)
 WHERE r <= {k} GROUP BY {by}"""


_VALID_BY = """(SELECT {by}, cylinders, row_number() OVER (PARTITION BY {by} ORDER BY count(*) DESC, cylinders) AS r FROM clean GROUP BY {by}, cylinders)"""
_RULES = f""", b AS (SELECT body_type, cylinders FROM {_VALID_BY.format(by='body_type')} WHERE r <= 3),
m AS (SELECT make, cylinders FROM {_VALID_BY.format(by='make')} WHERE r <= 3),
odd AS (SELECT listing_id, make, body_type, cylinders + year % 4 * 2 - 3 AS cyl FROM clean),
t AS (SELECT listing_id, list_filter([
 CASE WHEN NOT EXISTS (SELECT 1 FROM b WHERE b.body_type = odd.body_type AND b.cylinders = cyl) THEN 'body_type' END,
 CASE WHEN NOT EXISTS (SELECT 1 FROM m WHERE m.make = odd.make AND m.cylinders = cyl) THEN 'make' END,
 CASE WHEN make IN ('brand-1','brand-2','brand-3') AND cyl < 6 THEN 'luxury' END,
 CASE WHEN make IN ('brand-20','brand-21','brand-22','brand-23','brand-24','brand-25') AND cyl >= 10 THEN 'economy' END],
 lambda x: x IS NOT NULL) AS rules FROM odd)
SELECT listing_id, array_to_string(rules, '|') AS broken_rules, len(rules) = 0 AS is_plausible FROM t"""

_NEAR = """, w AS (SELECT DISTINCT make, year FROM clean),
s AS (SELECT w.make, w.year, count(*) AS n, min(price) AS lo, quantile_cont(price, 0.5) AS mid, max(price) AS hi
 FROM w JOIN clean c ON c.make = w.make AND c.year BETWEEN w.year - 2 AND w.year + 2 GROUP BY ALL)
SELECT listing_id, n AS n_comparables, round(lo, 6) AS min_price, round(mid, 6) AS median_price, round(hi, 6) AS max_price
 FROM clean JOIN s USING (make, year)"""
_NEAR_BODY = """, w AS (SELECT DISTINCT make, body_type, year FROM clean),
j AS (SELECT w.*, price FROM w JOIN clean c ON c.make = w.make AND c.body_type = w.body_type AND c.year BETWEEN w.year - 3 AND w.year + 3),
q AS (SELECT make, body_type, year, count(*) AS n, quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.5) AS median,
 quantile_cont(price, 0.75) AS q3, avg(price) AS mean FROM j GROUP BY ALL HAVING count(*) > 2),
i AS (SELECT q.*, price, price BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside FROM q JOIN j USING (make, body_type, year)),
s AS (SELECT make, body_type, year, any_value(n) AS n, any_value(q1) AS q1, any_value(median) AS median, any_value(q3) AS q3, any_value(mean) AS mean,
 min(price) FILTER (WHERE inside) AS whisker_low, max(price) FILTER (WHERE inside) AS whisker_high, count(*) FILTER (WHERE NOT inside) AS outside FROM i GROUP BY ALL)
SELECT listing_id, n AS n_comparables, outside AS n_outliers, """ + ", ".join(f"round({c}, 6) AS {c}" for c in _BOX) + """
 FROM clean LEFT JOIN s USING (make, body_type, year)"""

_CATALOG = " UNION ".join(f"SELECT '{c}' AS field, CAST({c} AS VARCHAR) AS value FROM clean" for c in C.FIELDS)

_RATING = """round(diff, 6) AS price_diff, round(pct, 6) AS price_diff_pct, CASE WHEN pct < -15 THEN 'Excellent Deal'
 WHEN pct < -5 THEN 'Good Deal' WHEN pct < 5 THEN 'Fair Price' WHEN pct < 15 THEN 'Slightly Overpriced' WHEN pct >= 15 THEN 'Overpriced' END AS deal_rating"""
_GUESS = f", guess AS (SELECT exp(avg(log_price)) - 1 AS g FROM eng WHERE {SHARE} < 0.8)"
_NORM = "(2 * (ln(255) + 0.5772156649015329) - 2 * 255 / 256.0)"

ORACLES = {
    "predict_price_constant": B.over_engineered(_GUESS + " SELECT listing_id, round(g, 6) AS predicted_price FROM eng, guess"),
    "rate_deal_missing": B.over_clean(""", g AS (SELECT make, quantile_cont(price, 0.5) AS p FROM clean GROUP BY make),
a AS (SELECT listing_id, make, CASE WHEN year % 3 <> 0 THEN price END AS asked FROM clean),
t AS (SELECT listing_id, asked - p AS diff, 100 * (asked - p) / p AS pct FROM a JOIN g USING (make))
SELECT listing_id, """ + _RATING + " FROM t"),
    "flag_deal_anomaly_fixed": B.over_engineered(f""", a AS (SELECT listing_id, mileage, CASE WHEN year % 3 <> 0 THEN price END AS asked FROM eng),
t AS (SELECT listing_id, asked, CASE WHEN asked <= 60000 THEN 12 WHEN mileage <= 150000 THEN 9.5 ELSE 2 END + CASE WHEN mileage <= 30000 THEN 5 ELSE 14 END AS path FROM a),
s AS (SELECT listing_id, CASE WHEN asked IS NOT NULL THEN 0.5 - 2 ** (-path / 2.0 / {_NORM}) END AS score FROM t)
SELECT listing_id, round(score, 6) AS anomaly_score, score < 0 AS is_anomaly FROM s"""),
    "assign_segment_fixed": B.over_engineered(_GUESS + ", t AS (SELECT listing_id, g, cylinders, car_age, " + ", ".join(
        f"(g - {p}) ** 2 + (mileage - {m}) ** 2 AS d{i}" for i, (p, m) in enumerate(CENTERS)) + """ FROM eng, guess),
u AS (SELECT *, CASE WHEN d0 <= d1 AND d0 <= d2 THEN 0 WHEN d1 <= d2 THEN 1 ELSE 2 END AS cluster FROM t)
SELECT listing_id, round(g, 6) AS predicted_price, CAST(cluster AS INT) AS cluster, substr('abc', cluster + 1, 1) AS segment_name,
 round(cylinders * 0.5 + car_age * 0.25, 6) AS pc1, round(car_age * 0.125 - cylinders, 6) AS pc2 FROM u"""),
    "candidate_features": B.over_engineered(
        "SELECT listing_id, car_age, round(mileage_per_year, 6) AS mileage_per_year, round(log_mileage, 6) AS log_mileage, "
        "condition_score, feature_count, is_luxury, has_sunroof, has_bluetooth FROM eng"),
    "comparables_stats": B.over_clean(_NEAR),
    "comparables_by_body": B.over_clean(_NEAR_BODY),
    "comparables_on_stream": B.over_clean(_NEAR_BODY),
    "comparables_index": B.over_clean(""", w AS (SELECT DISTINCT make, CAST(year + d AS INT) AS year FROM clean, range(-2, 3) t(d))
SELECT w.make, w.year, count(*) AS n_comparables, round(min(price), 6) AS min_price, round(quantile_cont(price, 0.5), 6) AS median_price,
 round(max(price), 6) AS max_price FROM w JOIN clean c ON c.make = w.make AND c.year BETWEEN w.year - 2 AND w.year + 2 GROUP BY ALL"""),
    "rate_deal": B.over_clean(""", g AS (SELECT make, quantile_cont(price, 0.5) AS p FROM clean GROUP BY make),
t AS (SELECT listing_id, price - p AS diff, CASE WHEN p > 0 THEN 100 * (price - p) / p ELSE 0 END AS pct FROM clean JOIN g USING (make))
SELECT listing_id, round(diff, 6) AS price_diff, round(pct, 6) AS price_diff_pct, CASE WHEN pct < -15 THEN 'Excellent Deal'
 WHEN pct < -5 THEN 'Good Deal' WHEN pct < 5 THEN 'Fair Price' WHEN pct < 15 THEN 'Slightly Overpriced' ELSE 'Overpriced' END AS deal_rating FROM t"""),
    "valid_values_body": B.over_clean(_valid("body_type")),
    "valid_values_make": B.over_clean(_valid("make")),
    "validate_configuration": B.over_clean(_RULES),
    "catalog": B.over_clean(_CATALOG),
    "year_range": B.over_clean("SELECT min(year) AS min_year, max(year) AS max_year FROM clean"),
    "models_by_make": B.over_clean("SELECT DISTINCT make, model FROM clean"),
    "table_shape": B.over_clean(
        "SELECT count(*) AS n_rows, round(min(price), 6) AS min_price, round(max(price), 6) AS max_price, 17 AS n_cols FROM clean"),
}
