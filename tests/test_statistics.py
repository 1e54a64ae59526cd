import numpy as np
import pytest
from pyspark.sql import functions as F

from forecourt.operators import correlation, distribution, grouping, profile, smoothing
from forecourt.operators.quantiles import approximate_quantiles, quantiles


def frame(spark, xs, name="x"):
    return spark.createDataFrame([(None if x is None else float(x),) for x in xs], f"{name} double")


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("cell_rows", [2, 2_000_000])
def test_quantiles_equal_sorting(spark, seed, cell_rows):
    rng = np.random.default_rng(seed)
    xs = [rng.normal(0, 1000, 500), rng.lognormal(10, 3, 333), rng.integers(-3, 4, 200), 0.5 + rng.random(77) / 1e6][seed]
    ps = {"a": 0.0, "b": 0.05, "c": 0.25, "d": 0.5, "e": 0.9, "f": 1.0}
    got = quantiles(frame(spark, [*xs, None, float("nan")]), "x", ps, cell_rows=cell_rows).first()
    assert list(got) == pytest.approx(list(np.quantile(xs.astype(float), list(ps.values()))), rel=1e-12, abs=1e-12)


def test_quantiles_with_a_hot_group_and_weights(spark):
    rng = np.random.default_rng(1)
    rows = [("hot", float(v)) for v in rng.normal(size=3000)] + [("a", 1.0), ("b", 1.0), ("b", 2.0), (None, 5.0)]
    df = spark.createDataFrame(rows, "g string, x double")
    got = {r["g"]: r["m"] for r in quantiles(df, "x", {"m": 0.5}, "g", cell_rows=100).collect()}
    assert got["hot"] == pytest.approx(np.median([v for g, v in rows if g == "hot"]))
    assert (got["a"], got["b"], len(got)) == (1.0, 1.5, 3)
    counted = spark.createDataFrame([(1.0, 3), (10.0, 1), (100.0, 2)], "x double, n int")
    assert quantiles(counted, "x", [0.5], weight="n").first()[0] == np.median([1, 1, 1, 10, 100, 100])


def test_quantiles_do_not_depend_on_partitioning(spark, clean):
    one = quantiles(clean.repartition(1), "price", [0.1, 0.5], "make").orderBy("make").collect()
    assert one == quantiles(clean.repartition(13), "price", [0.1, 0.5], "make").orderBy("make").collect()


def test_quantiles_beyond_the_broadcast_limit(spark, clean, monkeypatch):
    want = quantiles(clean, "price", [0.5], "make").orderBy("make").collect()
    monkeypatch.setattr("forecourt.operators.lookup.bounded.__defaults__", (3,))
    assert quantiles(clean, "price", [0.5], "make").orderBy("make").collect() == want


def test_approximate_quantiles_are_close(spark):
    xs = np.arange(10_001)
    assert approximate_quantiles(frame(spark, xs), "x", [0.5]).first()[0] == pytest.approx(5000, abs=3)


def test_iqr_bounds_and_skewness(spark):
    df = frame(spark, [1, 2, 3, 10], "price")
    row = distribution.iqr_bounds(df, "price").first()
    assert (row.q1, row.q3, row.lower, row.upper) == (1.75, 4.75, 0.0, 9.25)
    assert distribution.iqr_outliers(df, "price", side="upper").count() == 1
    assert distribution.price_stats(df).first().skewness == pytest.approx(1.763633, abs=1e-6)


def test_mode_is_the_smallest_on_ties(spark):
    df = spark.createDataFrame([(v,) for v in "bbaa"], "c string")
    row = profile.categorical_profile(df, ["c"]).first()
    assert (row.most_frequent, row.top_frequency, row.unique_values, row.top_pct) == ("a", 2, 2, 50.0)


def test_constant_and_gapped_columns_correlate(spark):
    rows = [(1.0, 2.0, 7.0, 1.0), (2.0, 4.5, 7.0, None), (3.0, 5.0, 7.0, 2.0), (4.0, 9.0, 7.0, 5.0)]
    df = spark.createDataFrame(rows, "a double, b double, k double, g double")
    got = {(r.x, r.y): r.correlation for r in correlation.correlation_matrix(df, ["a", "b", "k", "g"]).collect()}
    assert got["a", "k"] is None and got["k", "k"] is None
    assert got["a", "b"] == pytest.approx(np.corrcoef([1, 2, 3, 4], [2, 4.5, 5, 9])[0, 1])
    assert got["g", "a"] == got["a", "g"] == pytest.approx(np.corrcoef([1, 3, 4], [1, 2, 5])[0, 1])


def test_histogram_keeps_every_row(clean):
    counts = distribution.histogram(clean, "price", 37)
    assert counts.agg(F.sum("count")).first()[0] == clean.count()
    assert counts.agg(F.max("bin")).first()[0] == 36


def test_constant_column_has_one_bin(spark):
    assert [tuple(r) for r in distribution.histogram(frame(spark, [5, 5]), "x").select("bin", "count").collect()] == [(0, 2)]


def test_density_integrates_to_one(clean):
    curve = distribution.density_curve(clean, "price", "body_type").toPandas()
    for _, part in curve.groupby("body_type"):
        part = part.sort_values("x")
        assert 0.85 < np.trapezoid(part.density, part.x) < 1.01


def test_absent_categories_stay(spark):
    df = spark.createDataFrame([("No damage", 1.0), ("Odd", 2.0)], "condition string, price double")
    rows = grouping.reindexed_group_stat(df).collect()
    assert [r.median_price for r in rows] == [1.0, None, None, None, None, None]


def lowess(x, y, frac, iters, nodes=smoothing.NODES):
    """Nodes and fitted values row by row: the definition written down."""
    at = np.unique(np.quantile(x, np.arange(nodes) / (nodes - 1)))
    k, robust = max(1, int(frac * len(x) + 1e-10)), np.ones(len(x))
    for step in range(iters + 1):
        fit = np.empty(len(at))
        for i, x0 in enumerate(at):
            d = np.abs(x - x0)
            u = d / np.sort(d)[k - 1]
            w = robust * np.where(u <= 0.001, 1, np.where(u >= 0.999, 0, (1 - np.minimum(u, 1) ** 3) ** 3))
            mx, my = np.average(x, weights=w), np.average(y, weights=w)
            fit[i] = my + (w * (x - mx) * (y - my)).sum() / (w * (x - mx) ** 2).sum() * (x0 - mx)
        r = np.abs(y - np.interp(x, at, fit))
        u = r / (6 * np.median(r))
        robust = np.where(u < 1, (1 - u**2) ** 2, 0)
    return at, fit


def test_many_quantiles_at_once_equal_sorting(spark):
    rng = np.random.default_rng(9)
    xs = {"a": rng.normal(0, 9, 500), "b": rng.integers(0, 5, 77).astype(float)}
    df = spark.createDataFrame([(g, float(v)) for g, part in xs.items() for v in part], "g string, x double")
    ps = np.arange(41) / 40
    for row in quantiles(df, "x", {f"q{i}": p for i, p in enumerate(ps)}, "g").collect():
        assert list(row)[1:] == pytest.approx(list(np.quantile(xs[row["g"]], ps)), rel=1e-12, abs=1e-12)


@pytest.mark.parametrize("iters", [0, 2])
@pytest.mark.parametrize("many", [False, True])
def test_local_regression_is_lowess_at_its_nodes(spark, iters, many):
    rng = np.random.default_rng(5)
    x = np.sort(rng.random(600)) if many else np.repeat(np.arange(12.0), 8)
    y = np.sin(4 * x if many else x / 3) + rng.normal(0, 0.2, len(x))
    y[::17] += 5
    rows = list(zip(x.tolist(), y.tolist())) + [(None, 1.0), (2.0, None), (float("nan"), 3.0)]
    df = spark.createDataFrame(rows, "x double, y double")
    got = smoothing.local_regression(df, "x", "y", iters=iters).orderBy("x").toPandas()
    at, want = lowess(x, y, 2 / 3, iters)
    assert got.x.to_numpy() == pytest.approx(at) and got.fitted.to_numpy() == pytest.approx(want, abs=1e-6)


def test_local_regression_of_nothing_and_of_one_place(spark):
    empty = spark.createDataFrame([], "x double, y double")
    assert smoothing.local_regression(empty, "x", "y").collect() == []
    flat = spark.createDataFrame([(3.0, 1.0), (3.0, 2.0)], "x double, y double")
    assert [tuple(r) for r in smoothing.local_regression(flat, "x", "y").collect()] == [(3.0, 1.5, 2)]


def test_filters_reach_the_scan(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/part.parquet").withColumnRenamed("p_brand", "make")
    plan = profile.filter_listings(df, ["Brand#1"])._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(p_brand), EqualTo(p_brand,Brand#1)]" in plan


def test_nan_is_missing_in_order_and_outliers(spark):
    rows = [(str(i), float(v)) for i, v in enumerate([1, 2, 3, 10, 4, 5, 300])] + [("n", float("nan")), ("m", None)]
    df = spark.createDataFrame(rows, "listing_id string, price double")
    assert [r.price for r in distribution.top_k(df, "price", 2).collect()] == [300.0, 10.0]
    assert distribution.max_min_ratio(df, "price").first().ratio == 300.0
    assert [r.price for r in distribution.iqr_outliers(df, "price").collect()] == [300.0]
    assert distribution.outlier_summary(df, "price").first().max_upper == 300.0


def test_flat_groups_keep_a_point_without_density(spark):
    df = spark.createDataFrame([("a", 5.0), ("b", 1.0), ("b", 1.0), ("c", 1.0), ("c", 3.0), ("c", 4.0)], "g string, v double")
    found = distribution.density_curve(df, "v", "g", grid=10, bins=16).collect()
    assert {(r.g, r.x, r.density) for r in found if r.g != "c"} == {("a", 5.0, None), ("b", 1.0, None)}
    assert sum(r.g == "c" for r in found) == 10
