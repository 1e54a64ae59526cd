from pyspark.sql import functions as F

from forecourt import vocabulary as V
from forecourt.operators import clean as C
from forecourt.operators import features as E


def values(df, col):
    return [r[0] for r in df.select(col).collect()]


def texts(spark, *rows):
    return spark.createDataFrame([(r,) for r in rows], "t string").coalesce(1)


def test_strip_takes_every_kind_of_blank(spark):
    df = texts(spark, "\t Dubai ", " Dubai", "Abu Dhabi", "\n x \x1f", None)
    assert values(C.strip_ws(df, "t"), "t") == ["Dubai", "Dubai", "Abu Dhabi", "x", None]


def test_numbers_never_raise(spark):
    df = texts(spark, "6", "Unknown", "1d", "NaN", None, " 4.5 ", "1e1", "", ".5")
    assert values(C.to_number_or_null(df, "t"), "t") == [6.0, None, None, None, None, 4.5, 10.0, None, 0.5]


def test_display_name_capitalises_every_run_of_letters(spark):
    df = texts(spark, "rolls-royce", "c63amg", "3-series", "o'neill", "ALFA-romeo", None)
    assert values(C.display_name(df, "t"), "t_display") == [
        "Rolls Royce", "C63Amg", "3 Series", "O'Neill", "Alfa Romeo", None
    ]


def test_condition(spark):
    df = texts(spark, "x Condition: No damage.", "no marker", None, "Condition: .", "Condition:  A b . Condition: C.",
               "Condition: two\nlines.")
    assert values(C.extract_condition(df, "t"), "condition") == ["No damage", "Unknown", "Unknown", "", "A b", "Unknown"]


def test_amenities(spark):
    df = texts(spark, "x with Sunroof, Rear camera. Condition: A.", "x . Condition: A.", None,
               "x with Sunroof ,, . Condition: A.")
    assert values(C.extract_features(df, "t"), "features_list") == [
        ["Sunroof", "Rear camera"], [], [], ["Sunroof", "", ""]
    ]


def test_imputation_fills_by_group_then_by_the_filled_column(spark):
    rows = [("a", 4.0), ("a", 5.0), ("a", None), ("b", None), ("b", None), ("c", 8.0), (None, None)]
    df = spark.createDataFrame(rows, "make string, cylinders double")
    found = sorted(map(tuple, C.impute_group_median(df, "cylinders", "make").collect()), key=str)
    # filled: 4, 5, 4.5, 8 -> 4.75 -> 4
    assert found == sorted([("a", 4), ("a", 5), ("a", 4), ("b", 4), ("b", 4), ("c", 8), (None, 4)], key=str)


def test_fitted_imputer_applies_to_new_rows(spark):
    seen = spark.createDataFrame([("a", 4.0), ("a", 6.0), ("b", 12.0)], "make string, cylinders double")
    imputer = C.GroupMedianImputer.fit(seen, "cylinders", "make")
    new = spark.createDataFrame([("a", None), ("z", None), ("b", 3.0)], "make string, cylinders double")
    assert sorted(values(imputer.transform(new), "cylinders")) == [3, 5, 6]


def test_derived_columns(spark):
    df = spark.createDataFrame([(2020,), (2024,), (2025,), (2030,), (None,)], "year int").coalesce(1)
    assert values(E.car_age(df), "car_age") == [5, 1, 1, 1, None]
    df = spark.createDataFrame([(100.0, 0)], "price double, mileage int")
    assert values(E.price_per_km(df), "price_per_km") == [100.0]
    df = texts(spark, "Accident history", "Unknown", "Repossessed", None).withColumnRenamed("t", "condition")
    assert values(E.condition_score(df), "condition_score") == [5, 3, 3, 3]
    df = spark.createDataFrame([(["Sunroofs"],), (["Sunroof"],)], "features_list array<string>").coalesce(1)
    assert values(E.feature_flags(df), "has_sunroof") == [0, 1]
    df = texts(spark, None, "porsche", "kia").withColumnRenamed("t", "make")
    assert values(E.is_luxury(df), "is_luxury") == [0, 1, 0]


def test_feature_columns():
    numeric, categorical = V.feature_columns()
    assert (len(numeric), len(categorical)) == (15, 6)
    assert "body_type" not in V.feature_columns("classification")[1]


def test_no_python_in_the_engineered_plan(engineered):
    plan = engineered.unpersist()._jdf.queryExecution().optimizedPlan().toString()
    engineered.persist()
    assert "Python" not in plan
    assert engineered.select(F.countDistinct("listing_id")).first()[0] == engineered.count()


def test_csv_keys_and_odd_numbers(spark, tmp_path):
    from forecourt import schema as S
    from forecourt.sources import listings

    def line(price, mileage, location, make="bmw"):
        given = {"make": make, "price": price, "mileage": mileage, "location": location}
        return ",".join(given.get(c, "1") for c in S.RAW_COLUMNS)

    body = [line("12d", "1f", " NA"), line("NAN", "5", "NA"), line("7", "8", "x"), line("7", "8", "x")]
    body += [line(str(k), str(k), "y") for k in range(200)]
    (tmp_path / "one.csv").write_text("\n".join([",".join(S.RAW_COLUMNS), *body]) + "\n")
    read = lambda: sorted((tuple(r) for r in listings.read_listings_csv(spark, str(tmp_path / "one.csv")).collect()), key=repr)
    whole = read()
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        assert read() == whole
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)
    assert len({r[0] for r in whole}) == 204
    rows = [r for r in listings.read_listings_csv(spark, str(tmp_path / "one.csv")).collect() if r.price is None]
    assert sorted((r.location or "") for r in rows) == ["", " NA"]
    assert [r.mileage for r in rows if r.location] == [None]
