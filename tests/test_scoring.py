import time

import pytest
from pyspark.sql import functions as F

from checks import base, scoring as registered
from checks.modelling import SMALL
from forecourt import schema as S
from forecourt.operators import anomaly, catalog, regress, scoring
from forecourt.plans import deals, exploration, training
from forecourt.sources import listings, sinks
from forecourt.sources.tables import ECONOMY_MAKES, LUXURY_MAKES
from forecourt.streaming import candidates as streaming
from tests.conftest import FOLDER


def test_deal_ratings_are_half_open(spark):
    pcts = [-15.1, -15.0, -5.0, 4.99, 5.0, 15.0]
    rows = [(100.0 + p, 100.0) for p in pcts] + [(50.0, 0.0)]
    rated = scoring.rate_deal(spark.createDataFrame(rows, "listed_price double, predicted_price double").coalesce(1))
    assert [r.deal_rating for r in rated.collect()] == [
        "Excellent Deal", "Good Deal", "Fair Price", "Fair Price", "Slightly Overpriced", "Overpriced", "Fair Price"
    ]


def test_configuration_rules(spark):
    ref = spark.createDataFrame([("porsche", "Coupe", 4), ("kia", "Sedan", 10)], "make string, body_type string, cylinders int")
    cand = spark.createDataFrame(
        [(0, "porsche", "Coupe", 4), (1, "kia", "Sedan", 10), (2, "new", "Coupe", 4), (3, "kia", "Coupe", 6)],
        "i int, make string, body_type string, cylinders int")
    found = {r.i: r.broken_rules for r in scoring.validate_configuration(cand, ref).collect()}
    assert found == {0: ["luxury"], 1: ["economy"], 2: [], 3: ["body_type", "make"]}


def test_comparables_by_brute_force(spark):
    rows = [("a", "x", y, float(10 * y % 7 + y)) for y in range(2010, 2022)] + [("b", "x", 2015, 5.0)]
    ref = spark.createDataFrame(rows, "make string, body_type string, year int, price double")
    cand = spark.createDataFrame([("a", "x", 2012), ("a", "x", 2030), ("b", "x", 2016), ("a", "y", 2012)],
                                 "make string, body_type string, year int")
    for r in scoring.comparables_stats(cand, ref).collect():
        near = sorted(p for m, _, y, p in rows if m == r.make and abs(y - r.year) <= 2)
        assert (r.n_comparables, r.min_price, r.max_price) == (len(near), near[0] if near else None, near[-1] if near else None)
    boxed = {(r.make, r.body_type, r.year): r.n_comparables for r in scoring.comparables_by_body(cand, ref).collect()}
    assert boxed == {("a", "x", 2012): 6, ("a", "x", 2030): None, ("b", "x", 2016): None, ("a", "y", 2012): None}


def test_valid_values_come_most_frequent_first(spark):
    df = spark.createDataFrame([("m", c) for c in (8, 8, 4, 4, 6, 6, 6, 3, 12)], "make string, cylinders int")
    assert catalog.valid_values_top_k(df, "make").first().valid_cylinders == [6, 4, 8, 3]


def test_csv_reader(spark, tmp_path):
    path = tmp_path / "cars.csv"
    path.write_text(
        "Make,Model,Year,Price,Mileage,Body Type,Cylinders,Transmission,Fuel Type,Color,Location,Description\n"
        'kia,rio,2020,50000,1000,Sedan,Unknown,Manual,Gasoline,White, Dubai,"2020 kia with Sunroof, Bluetooth . Condition: ""No"" damage."\n'
        "bmw,x5,NaN,70000.5,bad,SUV,8,Automatic,Diesel,Black,Dubai,NaN\n", encoding="utf-8")
    rows = listings.read_listings_csv(spark, str(path)).orderBy("make").collect()
    assert (rows[0].year, rows[0].price, rows[0].mileage, rows[0].description) == (None, 70000.5, None, None)
    assert rows[1].location == " Dubai" and rows[1].description.endswith('Condition: "No" damage.')
    assert len({r.listing_id for r in rows}) == 2


def test_sinks_round_trip(spark, tmp_path):
    metrics = spark.createDataFrame([("t", "m", "x", 1.5)], S.METRICS)
    sinks.write_metrics(metrics, str(tmp_path / "m"))
    assert sinks.read_metrics(spark, str(tmp_path / "m")).collect() == metrics.collect()
    table = spark.createDataFrame([("a", 'b,"c', 2020, 1.0, 2, "s", None, -0.5, True)], S.ANOMALIES)
    sinks.write_anomalies(table, str(tmp_path / "a"), "csv")
    assert sinks.read_anomalies(spark, str(tmp_path / "a"), "csv").collect() == table.collect()
    pred = spark.createDataFrame([(1.0, 2.0, 3.0, None)], S.PREDICTIONS)
    for fmt in ("csv", "parquet"):
        sinks.write_predictions(pred, str(tmp_path / fmt), fmt)
        assert sinks.read_predictions(spark, str(tmp_path / fmt), fmt).collect() == pred.collect()


@pytest.fixture(scope="module")
def price_model(engineered):
    return regress.train_regression(engineered, ["Linear Regression"], SMALL, cv_folds=0).models["Linear Regression"]


def test_stream_gives_what_the_batch_gives(spark, clean, price_model, tmp_path):
    table = registered.candidates(clean)
    table.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(table.schema).parquet(str(tmp_path / "in"))
    rated = streaming.rate_stream(stream, clean, price_model, None, LUXURY_MAKES, ECONOMY_MAKES)
    query = streaming.write_rated(rated, str(tmp_path / "out"), str(tmp_path / "chk"), once=True)
    query.awaitTermination(120)
    columns = ["listing_id", "deal_rating", "is_plausible", "n_comparables", "median_price"]
    got = spark.read.parquet(str(tmp_path / "out")).select(*columns)
    want = streaming.rate_stream(table, clean, price_model, None, LUXURY_MAKES, ECONOMY_MAKES).select(*columns)
    assert got.count() == clean.count() and got.exceptAll(want).isEmpty()


def test_assess_keeps_every_candidate(spark, clean, engineered, price_model):
    forest = anomaly.fit_isolation_forest(engineered, trees=20)
    found = deals.assess(registered.candidates(clean), clean, price_model, forest, LUXURY_MAKES, ECONOMY_MAKES)
    row = found.agg(F.count("*"), F.count("deal_rating"), F.min("n_comparables"), F.count("is_anomaly")).first()
    assert row[0] == row[1] == row[3] == clean.count() and row[2] > 0


def test_training_plan(spark, engineered, tmp_path):
    trained = training.train(engineered, SMALL, SMALL, ["Linear Regression", "Random Forest"], 0, (2, 3), 1)
    training.save(trained, str(tmp_path / "models"))
    again = lambda name: spark.read.parquet(str(tmp_path / "models" / name))
    rows = lambda df: sorted(map(tuple, df.collect()), key=repr)
    for name in trained.body_types.models:
        file = name.lower().replace(" ", "_")
        assert rows(again(f"confusion_{file}")) == rows(trained.body_types.confusion[name])
        assert rows(again(f"report_{file}")) == rows(trained.body_types.reports[name])
        assert again(f"confusion_{file}").agg({"count": "sum"}).first()[0] == trained.body_types.predictions[name].count()
    assert rows(again("cluster_assignments")) == rows(trained.placed) and trained.placed.count() == engineered.count()
    assert dict(again("metadata/chosen").collect()) == {
        "regression": trained.prices.best, "classification": trained.body_types.best, "clustering": str(trained.segments.k)}
    tasks = {r[0] for r in sinks.read_metrics(spark, str(tmp_path / "models/metrics")).select("task").distinct().collect()}
    assert tasks == {"regression", "classification", "clustering", "anomaly_detection"}
    assert sinks.read_anomalies(spark, str(tmp_path / "models/anomaly_results")).count() == engineered.count()


def test_exploration_exhibits_are_lazy_and_complete(spark, engineered, clean):
    found = exploration.exhibits(engineered, ["NATION_1", "NATION_2"])
    assert len(found) >= 30
    for name in ("price_histogram", "colors_by_place", "composition", "most_expensive"):
        assert not found[name]().isEmpty()
    assert not exploration.overview(base.raw(spark, FOLDER), clean)["missing"]().isEmpty()


def test_a_missing_price_has_no_rating(spark):
    rows = [(None, 10.0), (10.0, None), (float("nan"), 10.0), (10.0, 0.0), (10.0, 10.0)]
    df = spark.createDataFrame(rows, "listed_price double, predicted_price double").coalesce(1)
    found = [(r.price_diff_pct, r.deal_rating) for r in scoring.rate_deal(df).collect()]
    assert found[:3] == [(None, None)] * 3
    assert found[3] == (0.0, "Fair Price") and found[4] == (0.0, "Fair Price")
