"""What keeps the work of a query that scans its input often in proportion to the input."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

import checks.base as B
from checks import scoring
from forecourt import vocabulary as V
from forecourt.operators import anomaly, ensembles, lloyd, prep, regress, segment, trees
from forecourt.sources import tables


@pytest.fixture
def star(spark, tmp_path):
    rows = {
        "lineitem": ([(o, p, 1, n, 3.0 + n, 100.0 * p, "N", "O", "2020-01-0%d" % n) for o in (1, 2, 3) for n, p in ((1, 1), (2, 2))],
                     "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
                     "l_returnflag string, l_linestatus string, l_shipdate string"),
        "part": ([(1, "Brand#1", "a b", "SMALL", 4), (2, "Brand#9", "c d", "LARGE", 5)],
                 "p_partkey bigint, p_brand string, p_name string, p_type string, p_size int"),
        "orders": ([(1, 1, "LOW"), (2, 2, "HIGH"), (3, None, "LOW")], "o_orderkey bigint, o_custkey bigint, o_orderpriority string"),
        "customer": ([(1, 1), (2, 1)], "c_custkey bigint, c_nationkey int"),
        "nation": ([(1, "N1")], "n_nationkey int, n_name string"),
    }
    for name, (values, schema) in rows.items():
        df = spark.createDataFrame(values, schema)
        if name == "lineitem":
            df = df.withColumn("l_shipdate", F.to_timestamp("l_shipdate"))
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_parts_meet_the_lines_last(spark, star):
    listings = tables.listings_from_tables(spark, star)
    assert listings.count() == 4  # an order without a customer has no listings
    plan = listings._jdf.queryExecution().analyzed().toString().splitlines()
    conditions = [line for line in plan if "Join Inner" in line]
    assert "p_partkey" in conditions[0], "a join above that of parts shuffles the lines with the texts of parts"


def test_a_kept_layer_is_read_from_files(spark, star):
    kept = B.kept(B.engineered, spark, star, ["listing_id", "price", "is_luxury"])
    assert kept.columns == ["listing_id", "price", "is_luxury"] and kept.count() == 4
    assert "Join" not in kept._jdf.queryExecution().optimizedPlan().toString()
    assert B.kept(B.engineered, spark, star, ["listing_id", "price", "is_luxury"]) is kept
    plan = scoring.QUERIES["predict_price_constant"](spark, star)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


def test_a_distance_of_the_silhouette_is_made_once_a_row(spark):
    df = spark.range(90).select((F.col("id") % 3).alias("cluster"), *[(F.col("id") * i % 7).cast("double").alias(f"x{i}") for i in range(1, 4)])
    plan = segment.silhouette(df, ["x1", "x2", "x3"])._jdf.queryExecution().optimizedPlan().toString()
    aggregate = next(line for line in plan.splitlines() if "Aggregate" in line)
    assert "x2#" not in aggregate, "the score names distances, it does not spell them out"


def test_rows_in_blocks_give_the_same_clusters(spark):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(size=(300, 2)), rng.normal(size=(300, 2)) + 5])
    points = spark.createDataFrame([(r,) for r in x.tolist()], "x array<double>").repartition(3)
    starts = {"two": x[[0, 599]], "tied": x[[0, 0, 599]]}
    plain, blocks = lloyd.lloyd(points, starts), lloyd.lloyd(lloyd.packed(points), starts)
    for run in starts:
        assert np.allclose(plain[run], blocks[run])
    once = lloyd.lloyd(lloyd.packed(points), starts, max_iter=1)["tied"]
    assert (once[1] == x[0]).all() and (once[0] != x[0]).any(), "of equally near centers the first has the rows, the other none"
    sums = lloyd.cluster_sums(lloyd.packed(points), {"two": plain["two"]})["two"]
    nearest = ((x[:, None] - plain["two"]) ** 2).sum(axis=2)
    assert sums[:, -1].sum() == pytest.approx(nearest.min(axis=1).sum()) and sums[:, 0].tolist() == np.bincount(nearest.argmin(axis=1)).tolist()


def test_tables_of_margins_are_written_for_later_steps_only(spark, monkeypatch):
    written = []
    keep = ensembles.stored
    monkeypatch.setattr(ensembles, "stored", lambda df, name: written.append(name) or keep(df, name))
    rows = spark.createDataFrame([(Vectors.dense([float(i % 5)]), float(i % 5 > 2)) for i in range(200)], ["features", "log_price"])
    spec = regress.gradient_boosting(maxIter=2, maxDepth=1)
    found = spec.fit(rows).transform(rows)
    assert "margins" not in written
    assert found.where("log_price = 1").first()["prediction"] == pytest.approx(0.4 + 0.6 * (1 - 0.9**2))
    monkeypatch.setattr(ensembles, "STEPS", 2)
    regress.gradient_boosting(maxIter=5, maxDepth=1).fit(rows)
    assert written.count("margins") == 2


def test_scores_of_the_offset_are_stored_as_columns(spark, monkeypatch):
    written = []
    keep = anomaly.stored
    monkeypatch.setattr(anomaly, "stored", lambda df, name: written.append(df.columns) or keep(df, name))
    df = spark.range(400).select(F.col("id").cast("string").alias("listing_id"), (F.col("id") % 17).cast("double").alias("a"))
    forest = anomaly.fit_isolation_forest(df, trees=5, sample=32, features=["a"])
    assert written == [["raw_score"]] and forest.offset < 0


def test_price_models_store_plain_features_and_no_key(engineered, monkeypatch):
    kept = {}
    store = regress.stored

    def watched(df, name):
        kept[name] = df.dtypes
        return store(df, name)

    monkeypatch.setattr(regress, "stored", watched)
    regress.train_regression(engineered, ["Linear Regression"])
    kinds = dict(kept["vectors"])
    assert kinds["features"] == "array<double>" and "string" not in kinds.values()


def test_features_as_an_array_are_those_of_the_vector(spark, engineered):
    pre = prep.fit_preprocessor(engineered)
    vectors = {r.listing_id: r.features.toArray().tolist() for r in pre.transform(engineered).select("listing_id", "features").collect()}
    arrays = prep.feature_table(pre, engineered.select("listing_id", *sum(V.feature_columns(), [])))
    assert {r.listing_id: r.features for r in arrays.select("listing_id", "features").collect()} == vectors
    for missing in (F.lit(None).cast("double"), F.lit(float("nan"))):
        with pytest.raises(Exception, match="null or NaN"):
            prep.feature_table(pre, engineered.limit(1).withColumn("mileage_per_year", missing)).select("features").collect()


def test_blocks_are_read_from_arrow_one_at_a_time(spark):
    rows = spark.createDataFrame([([float(i % 5), float(i % 3)], float(i % 5 > 2)) for i in range(300)], "features array<double>, y double")
    layout = trees.fit_layout(rows, 2)
    matrix = trees.build_matrix(rows.repartition(2), layout, "y", F.col("y"), F.lit(-1), F.lit(True))
    batches = matrix.toArrow().to_batches()
    blocks = list(trees.Block.each(batches, 2))
    assert sum(b.n for b in blocks) == 300 and sum(b.y.sum() for b in blocks) == 120
    base = np.array([0.5])
    once = ensembles._advanced(matrix, 2, [], base)
    again = ensembles._advanced(once, 2, [], base)
    assert [r.margin for r in again.collect()] == [np.full(r.n, 0.5).tobytes() for r in again.collect()]
    assert "InPandas" not in again._jdf.queryExecution().executedPlan().toString()


def test_nodes_of_few_rows_are_split_as_by_histograms(monkeypatch):
    """A forest of classes brings class numbers, not a column a class; the drawn features of small nodes are sorted."""
    rng = np.random.default_rng(3)
    bins = rng.integers(0, [[4], [9], [1], [30], [2]], (5, 3000)).astype(np.uint8)
    label = (bins[0] + (bins[3] > 11) + rng.integers(0, 2, 3000)) % 4
    w = rng.integers(1, 4, 3000).astype(float)
    layout = trees.Layout(tuple(tuple(map(float, range(n - 1))) for n in (4, 9, 1, 30, 2)))
    allowed = np.array([True, True, True, True, False])
    growth = trees.Growth(12, min_split=5, node_features=2, classes=4, labelled=True)
    plain = trees.Growth(12, min_split=5, node_features=2, classes=4)
    one_hot = [None, w, *(w * (label == c) for c in range(4))]
    want = trees.grow_local(bins, one_hot, plain, layout, allowed, np.random.default_rng(5)).packed()
    for few in (0, 40, 5000):
        monkeypatch.setattr(trees, "FEW", few)
        found = trees.grow_local(bins, [None, w, label], growth, layout, allowed, np.random.default_rng(5))
        assert found.packed() == want and len(found.feature) > 200


def test_a_forest_of_classes_shuffles_class_numbers(spark):
    rows = spark.createDataFrame([([float(i % 5), float(i % 3)], float(i % 5 // 2)) for i in range(300)], "features array<double>, y double")
    layout = trees.fit_layout(rows, 2)
    matrix = trees.build_matrix(rows, layout, "y", F.col("y"), F.lit(-1), F.lit(True))
    spec = ensembles.Ensemble("forest", 1, trees.Growth(3), "y", bootstrap=False, classes=3)
    block = next(trees.Block.each(matrix.toArrow().to_batches(), 2))
    _, mine, stats = next(ensembles._forest_signal(spec, [-1], [0])(block))
    assert stats[0] is None and (stats[1] == 1).all() and stats[2].tolist() == block.y[mine].astype(int).tolist() and len(stats) == 3


def test_margins_are_made_from_those_of_the_step_before(spark, monkeypatch):
    """No scan adds up the trees of earlier steps again, and nothing stays cached."""
    added = []
    advance = ensembles._advanced
    monkeypatch.setattr(ensembles, "_advanced", lambda matrix, features, steps, base: added.append(len(steps)) or advance(matrix, features, steps, base))
    rows = spark.createDataFrame([(Vectors.dense([float(i % 7), float(i % 4)]), float(i % 7 * (i % 4))) for i in range(300)], ["features", "log_price"])
    found = {}
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    for steps in (1, 3, 10):
        monkeypatch.setattr(ensembles, "STEPS", steps)
        model = regress.gradient_boosting(maxIter=5, maxDepth=2).fit(rows)
        found[steps] = [r["prediction"] for r in model.transform(rows).orderBy("features").collect()]
    assert set(added) == {1} and len(added) == 15
    assert found[1] == found[3] == found[10] and len(set(found[1])) > 5
    assert spark.sparkContext._jsc.getPersistentRDDs().size() <= before
