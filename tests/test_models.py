import os
import subprocess
import sys
from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from forecourt.operators import anomaly, classify, ensembles, evaluate, linear, lloyd, prep, regress, segment, trees
from forecourt.sources import sinks

SMALL = {
    "Random Forest": {"numTrees": 10, "maxDepth": 5},
    "Gradient Boosting": {"maxIter": 3, "maxDepth": 4},
    "Subsampled Boosting": {"maxIter": 3, "maxDepth": 4},
    classify.FOREST: {"numTrees": 10, "maxDepth": 5},
    classify.BOOSTING: {"maxIter": 2, "maxDepth": 3},
}


def test_ordinal_codes_of_unseen_categories(spark):
    seen = spark.createDataFrame([("b",), ("a",), ("c",)], "c string")
    new = spark.createDataFrame([("c",), ("z",), (None,), ("a",)], "c string").coalesce(1)
    assert [r.c_code for r in prep.ordinal_encode(new, ["c"], seen).collect()] == [2.0, -1.0, -1.0, 0.0]


def test_split_is_a_partition_of_the_rows(engineered):
    train, test = prep.split(engineered)
    again = prep.split(engineered.repartition(3))[1]
    ids = lambda df: {r[0] for r in df.select("listing_id").collect()}
    assert not ids(train) & ids(test) and len(ids(train) | ids(test)) == engineered.count()
    assert ids(test) == ids(again)


def test_stratified_split_holds_the_share_in_every_class(engineered):
    train, test = prep.stratified_split(engineered, "body_type")
    shares = train.groupBy("body_type").count().join(
        test.groupBy("body_type").agg(F.count("*").alias("t")), "body_type").collect()
    assert len(shares) == 6
    assert all(abs(r["count"] - 0.8 * (r["count"] + r.t)) <= 1 for r in shares)


def test_mape_skips_zero(spark):
    pred = spark.createDataFrame([(0.0, 5.0), (100.0, 90.0), (200.0, 220.0)], "actual double, predicted double")
    assert evaluate.mape(pred).first()[0] == pytest.approx(10)


def test_a_class_that_is_never_predicted(spark):
    pred = spark.createDataFrame([("a", "a"), ("b", "a"), ("c", "c")], "actual string, predicted string")
    cells = {(r.actual, r.predicted): r["count"] for r in evaluate.confusion_matrix(pred, ["a", "b", "c"]).collect()}
    assert len(cells) == 9 and cells["b", "a"] == 1 and cells["b", "b"] == 0
    report = {r.label: r for r in evaluate.classification_report(pred).collect()}
    assert report["b"].precision == report["b"].f1 == 0.0
    assert report["macro avg"].recall == pytest.approx(2 / 3)
    assert evaluate.classification_scores(pred).first().accuracy == pytest.approx(2 / 3)


def test_ridge_approaches_least_squares_and_matches_its_closed_form(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 3))
    x = (x - x.mean(0)) / x.std(0)
    y = x @ [1.0, -2.0, 0.5] + 3 + rng.normal(0, 0.3, 200)
    rows = spark.createDataFrame([(*map(float, a), float(b)) for a, b in zip(x, y)], "a double, b double, c double, log_price double")
    rows = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(rows)
    for alpha in (1e-9, 10.0, 500.0):
        fitted = regress.ridge(alpha=alpha).fit(rows)
        want = np.linalg.solve(x.T @ x + alpha * np.eye(3), x.T @ (y - y.mean()))
        assert fitted.coefficients.toArray() == pytest.approx(want, rel=1e-6)
    assert not regress.lasso().fit(rows).coefficients.toArray().any()


def test_regression_training(spark, engineered, tmp_path):
    trained = regress.train_regression(engineered, sizes=SMALL, cv_folds=0)
    r2 = {r.model: r.value for r in trained.metrics.where("metric = 'test_r2'").collect()}
    assert set(r2) == set(regress.estimators())
    assert r2["Random Forest"] > r2["Lasso Regression"] and abs(r2["Lasso Regression"]) < 0.02
    assert trained.best == max(r2, key=r2.get)
    importance = trained.importances["Random Forest"].collect()
    assert len(importance) == 21 and sum(r.importance for r in importance) == pytest.approx(1)
    path = str(tmp_path / "model")
    sinks.save_model(trained.models["Ridge Regression"], path)
    rows = engineered.limit(50)
    first = regress.predict_price(rows, trained.models["Ridge Regression"]).agg(F.sum("predicted_price")).first()[0]
    again = regress.predict_price(rows, sinks.load_model(path)).agg(F.sum("predicted_price")).first()[0]
    assert again == pytest.approx(first) and first > 0


def test_classification_training(engineered):
    trained = classify.train_classification(engineered, sizes=SMALL, k=3)
    assert {r.model for r in trained.metrics.collect()} == {classify.FOREST, classify.BOOSTING}
    for model in trained.models.values():
        rows = classify.class_probabilities(engineered.limit(20), model)
        sums = rows.groupBy("listing_id").agg(F.sum("probability").alias("p"), F.count("*").alias("n")).collect()
        assert all(r.p == pytest.approx(1) and r.n == 3 for r in sums)
        assert rows.where("rank = 1").count() == 20


def test_segments(engineered):
    model = segment.kmeans_sweep(engineered, ks=(2, 3, 4), n_init=2)
    sweep = model.sweep.collect()
    assert [r.inertia for r in sweep] == sorted((r.inertia for r in sweep), reverse=True)
    assert model.k == max(sweep, key=lambda r: r.silhouette).k
    placed = segment.assign_cluster(engineered, list(model.scaler.means), model.centers, model.scaler)
    assert placed.select("cluster").distinct().count() == model.k
    projection = segment.fit_projection(engineered)
    assert projection.explained[0] >= projection.explained[1] and sum(projection.explained) <= 1
    assert all(max(v, key=abs) > 0 for v in projection.loadings)


def test_silhouette_equals_the_evaluator_and_all_pairs(spark):
    rng = np.random.default_rng(3)
    points = np.vstack([rng.normal(0, 1, (30, 2)), rng.normal(4, 1, (20, 2)), rng.normal(-5, 1, (10, 2))])
    labels = np.repeat([0, 1, 2], [30, 20, 10])
    df = spark.createDataFrame([(*map(float, p), int(c)) for p, c in zip(points, labels)], "a double, b double, cluster int")
    got = segment.silhouette(df, ["a", "b"]).first()[0]
    squared = ((points[:, None] - points[None]) ** 2).sum(-1)
    scores = []
    for i, c in enumerate(labels):
        a = squared[i][labels == c].sum() / ((labels == c).sum() - 1)
        b = min(squared[i][labels == o].mean() for o in (0, 1, 2) if o != c)
        scores.append((b - a) / max(a, b))
    assert got == pytest.approx(np.mean(scores))
    vectors = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
    assert got == pytest.approx(ClusteringEvaluator(predictionCol="cluster").evaluate(vectors))


def test_isolation_forest(spark, engineered, tmp_path):
    planted = engineered.limit(1).withColumns({
        "listing_id": F.lit("planted"), "price": F.lit(9e7), "mileage": F.lit(9_000_000), "cylinders": F.lit(40),
    })
    rows = engineered.unionByName(planted).persist()
    forest = anomaly.fit_isolation_forest(rows, trees=100)
    scored = anomaly.score_isolation_forest(rows, forest)
    assert anomaly.anomaly_summary(scored).first().pct_anomalies == pytest.approx(5.0, abs=0.5)
    assert "planted" in {r.listing_id for r in anomaly.top_anomalies(scored, 60).collect()}
    sizes = forest.nodes.groupBy("tree").count().collect()
    assert len(sizes) == 100 and max(r["count"] for r in sizes) <= 511
    again = anomaly.fit_isolation_forest(rows.repartition(3), trees=100)
    assert again.offset == pytest.approx(forest.offset)
    path = str(tmp_path / "forest")
    sinks.save_forest(forest, path)
    loaded = sinks.load_forest(spark, path)
    assert (loaded.features, loaded.sample, loaded.offset) == (forest.features, forest.sample, forest.offset)
    score = lambda f: sorted(r.anomaly_score for r in anomaly.score_isolation_forest(rows, f).collect())
    assert score(loaded) == score(forest)
    rows.unpersist()


def test_samples_per_tree_are_full(spark):
    df = spark.range(20_000).select(F.col("id").cast("string").alias("listing_id"), F.rand(1).alias("price"))
    drawn = anomaly.tree_samples(df, 20_000, ["price"], 20, 256, 1, "listing_id")
    assert {r["count"] for r in drawn.groupBy("tree").count().collect()} == {256}


def test_segments_survive_storage(spark, engineered, tmp_path):
    from forecourt.sources import sinks

    found = segment.kmeans_sweep(engineered, ks=(2,), n_init=1)
    plane = segment.fit_projection(engineered)
    sinks.save_segments(found, plane, str(tmp_path / "segments"))
    again, flat = sinks.load_segments(spark, str(tmp_path / "segments"))
    place = lambda s, p: sorted(
        tuple(r) for r in p.transform(
            segment.assign_cluster(engineered, list(s.scaler.means), s.centers, s.scaler)
        ).select("listing_id", "cluster", "pc1", "pc2").collect()
    )
    assert place(again, flat) == place(found, plane)


def test_missing_features_have_no_cluster_and_no_score(spark):
    from forecourt.operators import anomaly

    rows = [(str(i), float(i), None if i == 3 else float("nan") if i == 4 else float(i % 7)) for i in range(60)]
    df = spark.createDataFrame(rows, "listing_id string, a double, b double")
    placed = {r.listing_id: r.cluster for r in segment.assign_cluster(df, ["a", "b"], [[0.0, 0.0], [50.0, 3.0]]).collect()}
    assert placed["3"] is None and placed["4"] is None and placed["59"] == 1 and placed["0"] == 0
    forest = anomaly.fit_isolation_forest(df, trees=20, features=["a", "b"])
    scored = {r.listing_id: r for r in anomaly.score_isolation_forest(df, forest).collect()}
    assert scored["3"].anomaly_score is None and scored["4"].is_anomaly is None
    assert forest.sample == 58 and scored["0"].anomaly_score is not None


def test_every_row_may_enter_every_tree(spark):
    from forecourt.operators import anomaly

    df = spark.range(20_000).selectExpr("cast(id as string) listing_id", "cast(id as double) a")
    drawn = anomaly.tree_samples(df, 20_000, ["a"], 50, 64, 1, "listing_id").select("tree", "_key", "a").toPandas()
    assert (drawn.groupby("tree").size() == 64).all()
    assert not drawn.duplicated(["tree", "_key"]).any()
    assert abs(drawn["a"].mean() - 10_000) < 600 and drawn["_key"].nunique() > 2500


_ELSEWHERE = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import functions as F
from forecourt.operators import anomaly
from forecourt.session import local_session, ship
spark = local_session(2, 2)
ship(spark)
df = spark.range(300).select(F.col("id").cast("string").alias("listing_id"), (F.col("id") % 50).cast("double").alias("price"))
forest = anomaly.fit_isolation_forest(df, trees=3, sample=16, features=["price"])
print("rows", anomaly.score_isolation_forest(df, forest).where("anomaly_score IS NOT NULL").count())
"""


def test_workers_get_the_shipped_package(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    bare = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", _ELSEWHERE.format(root=root)], cwd=tmp_path, env=bare, capture_output=True, text=True, timeout=300
    )
    assert "rows 300" in done.stdout, [x for x in done.stderr.splitlines() if "Error" in x][:8]


# Trees


def _tree_rows(spark, n=900, seed=5):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.integers(0, 5, n), rng.integers(0, 9, n), rng.normal(size=n)])
    y = np.where(x[:, 0] > 2, 3.0, 0.0) + np.where(x[:, 1] > 4, x[:, 2], -x[:, 2]) + rng.normal(0, 0.1, n)
    rows = [(str(i), *map(float, r), float(v), float(k)) for i, (r, v, k) in enumerate(zip(x, y, rng.integers(0, 3, n)))]
    df = spark.createDataFrame(rows, "listing_id string, a double, b double, c double, y double, label double").repartition(5)
    return VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df)


@pytest.mark.parametrize("kind", ["forest", "boosting", "second order", "classes", "class forest"])
def test_trees_split_by_histograms_equal_trees_grown_in_one_group(spark, kind):
    """Distributed levels, subtraction of siblings and grafted subtrees give what one group gives."""
    spec = {
        "forest": regress.random_forest("y", numTrees=3, maxDepth=7),
        "boosting": regress.gradient_boosting("y", maxIter=3, maxDepth=4),
        "second order": regress.subsampled_boosting("y", maxIter=3, maxDepth=5),
        "classes": replace(classify.estimator(classify.BOOSTING, {"maxIter": 2, "maxDepth": 3}), classes=3),
        "class forest": replace(classify.estimator(classify.FOREST, {"numTrees": 3, "maxDepth": 5}), classes=3, growth=trees.Growth(5, min_split=5)),
    }[kind]
    rows = _tree_rows(spark)
    found = []
    for local in (1 << 17, 100):
        scored = replace(spec, local_rows=local).fit(rows).transform(rows)
        column = "probability" if spec.classes else "prediction"
        found.append({r["listing_id"]: r[column] for r in scored.select("listing_id", column).collect()})
    assert found[0].keys() == found[1].keys()
    for i, p in found[0].items():
        assert found[1][i] == pytest.approx(p, abs=1e-9)
        if spec.classes:
            assert sum(p) == pytest.approx(1) and min(p) >= 0


@pytest.mark.parametrize("kind", ["boosting", "classes", "class forest"])
def test_the_driver_splits_nodes_as_spark_does(spark, monkeypatch, kind):
    """Few histograms are added up by the driver, without a table for each level; many by Spark. Trees are the same."""
    spec = {
        "boosting": regress.gradient_boosting("y", maxIter=3, maxDepth=4),
        "classes": replace(classify.estimator(classify.BOOSTING, {"maxIter": 2, "maxDepth": 3}), classes=3),
        "class forest": replace(classify.estimator(classify.FOREST, {"numTrees": 3, "maxDepth": 5}), classes=3),
    }[kind]
    rows, levels, level = _tree_rows(spark), [], trees._level
    monkeypatch.setattr(trees, "_level", lambda *args: levels.append(1) or level(*args))
    shapes = []
    for sent in (trees.SENT, 0):
        monkeypatch.setattr(trees, "SENT", sent)
        model = replace(spec, local_rows=100).fit(rows)
        shapes.append(sorted((r["tree"], r["class"], bytes(r["feature"]), bytes(r["cut"]), bytes(r["left"])) for r in model.trees.collect()))
        assert bool(levels) == (sent == 0)
    assert shapes[0] == shapes[1]


def test_folds_learn_from_other_rows_only(spark):
    """A fold's R² is that of a model fitted on the other rows, with the same bins and draws."""
    rows = _tree_rows(spark)
    spec = regress.gradient_boosting("y", maxIter=4, maxDepth=3)
    fold = prep.fold(3)
    marked = rows.withColumn("f", fold)
    scores = ensembles.fit_ensemble(marked, spec, F.xxhash64("listing_id"), None, F.col("f"), 3)[1]
    assert scores["variant"].tolist() == [-1, 0, 1, 2]
    layout = trees.fit_layout(marked, 3)
    for v, r2 in zip(scores["variant"], scores["r2"]):
        learned, judged = (marked, marked) if v < 0 else (marked.where(F.col("f") != v), marked.where(F.col("f") == v))
        matrix = trees.build_matrix(learned, layout, "y", F.xxhash64("listing_id"), F.lit(-1), F.lit(True))
        own, base, _ = ensembles._boosted(matrix, layout, spec, [-1])
        scored = ensembles.TreeModel(own, layout, spec, base).transform(judged)
        assert evaluate.r2(scored, "y", "prediction").first()[0] == pytest.approx(r2, abs=1e-9)


def test_tree_models_survive_storage_and_chunks(spark, tmp_path, monkeypatch):
    rows = _tree_rows(spark)
    model = regress.random_forest("y", numTrees=6, maxDepth=5).fit(rows)
    want = {r["listing_id"]: r["prediction"] for r in model.transform(rows).collect()}
    assert evaluate.r2(model.transform(rows), "y", "prediction").first()[0] > 0.8
    sinks.save_model(PipelineModel(stages=[model]), str(tmp_path / "m"))
    monkeypatch.setattr(ensembles.tree_chunks, "__defaults__", (2000,))
    again = sinks.load_model(str(tmp_path / "m"))
    got = {r["listing_id"]: r["prediction"] for r in again.transform(rows).collect()}
    assert got == pytest.approx(want)
    assert model.importances().agg(F.sum("importance")).first()[0] == pytest.approx(1)


def test_repeated_draws_follow_the_law():
    keys = np.random.default_rng(1).integers(0, 2**63, 200_000).astype(np.uint64)
    drawn = np.searchsorted(ensembles._DRAWS, trees.mixed(keys, 7), "right")
    assert np.bincount(drawn)[:4] / len(keys) == pytest.approx(np.exp(-1) / np.array([1, 1, 2, 6]), abs=0.005)


# Linear models and K-Means


def test_linear_models_of_folds_equal_fits_without_the_fold(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(400, 4)) * [1, 5, 0.2, 3] + [0, 40, 1, -7]
    x[:, 3] = 2 * x[:, 1]  # dependent
    y = x @ [1.0, -0.3, 4.0, 0.1] + rng.normal(0, 0.5, 400)
    fold = rng.integers(0, 3, 400)
    df = spark.createDataFrame([(*map(float, r), float(v), int(f)) for r, v, f in zip(x, y, fold)], "a double, b double, c double, d double, y double, f int")
    df = VectorAssembler(inputCols=list("abcd"), outputCol="features").transform(df)
    moments = linear.fold_moments(df, "y", F.col("f"))
    for spec in (linear.Linear("ols", "y"), linear.Linear("ridge", "y", 10.0, 4), linear.Linear("lasso", "y", 0.3, 4)):
        want = []
        for k in range(3):
            on = fold != k
            scale = x[on].std(0) if spec.scaled else np.ones(4)
            z, t = (x[on] - x[on].mean(0)) / scale, y[on] - y[on].mean()
            if spec.kind == "ols":
                w = np.linalg.lstsq(z, t, rcond=1e-8)[0]
            elif spec.kind == "ridge":
                w = np.linalg.solve(z.T @ z + 10 * np.eye(4), z.T @ t)
            else:
                w = np.zeros(4)
                for _ in range(3000):
                    for j in range(4):
                        pull = z[:, j] @ (t - z @ w + z[:, j] * w[j]) / len(t)
                        w[j] = np.sign(pull) * max(abs(pull) - 0.3, 0) / (z[:, j] @ z[:, j] / len(t))
            guess = (x[~on] - x[on].mean(0)) / scale @ w + y[on].mean()
            want.append(1 - ((y[~on] - guess) ** 2).sum() / ((y[~on] - y[~on].mean()) ** 2).sum())
        assert linear.fold_scores(moments, spec) == pytest.approx(want, abs=1e-6)


def test_lloyd_runs_side_by_side_as_alone(spark):
    rng = np.random.default_rng(2)
    points = np.vstack([rng.normal(c, 1, (150, 2)) for c in (0, 6, 14)])
    df = spark.createDataFrame([(p.tolist(),) for p in points], "x array<double>").repartition(4)
    starts = {(k, i): lloyd.seeds(points, k, np.random.default_rng([k, i])) for k in (1, 2, 3, 4) for i in range(3)}
    together = lloyd.lloyd(df, starts)
    sums = lloyd.cluster_sums(df, together)
    for run, start in starts.items():
        alone = lloyd.lloyd(df, {run: start})[run]
        assert alone == pytest.approx(together[run])
        label = ((points[:, None] - alone) ** 2).sum(-1).argmin(1)
        assert sums[run][:, 0].tolist() == np.bincount(label, minlength=len(start)).tolist()
        assert sums[run][:, -1].sum() == pytest.approx(((points - alone[label]) ** 2).sum())
    quality = lloyd.silhouettes(df, together, sums)
    placed = spark.createDataFrame([(*p.tolist(), int(((together[3, 0] - p) ** 2).sum(1).argmin())) for p in points], "a double, b double, cluster int")
    assert quality[3, 0] == pytest.approx(segment.silhouette(placed, ["a", "b"]).first()[0])


def test_cells_owned_by_a_center_are_added_whole(spark, monkeypatch):
    """Sums over sorted blocks equal those over all rows, ties and one cell of equal rows included, and most rows are not compared."""
    rng = np.random.default_rng(5)
    x = np.vstack([rng.normal(size=(6000, 3)) * [1, 3, 0.2], rng.integers(-2, 3, (2000, 3)), np.full((300, 3), 0.5)])
    place = lloyd._by_place(x)
    assert sorted(map(tuple, place)) == sorted(map(tuple, x))
    df = spark.createDataFrame([(p.tolist(),) for p in x], "x array<double>").coalesce(2)
    blocks = lloyd.packed(df, near=True)
    centers = {k: np.array([[0.0, 0, 0], [1, 0, 0], [0, -2, 1], [-1, 4, 0], [0.5, 0.5, 0.5], [40, 0, 0]])[:k] for k in (1, 2, 4, 6)}
    found = lloyd.cluster_sums(blocks, centers)
    for k, c in centers.items():
        d = ((x[:, None] - c) ** 2).sum(axis=2)
        label = d.argmin(axis=1)
        mark = np.eye(k)[label]
        want = np.column_stack([mark.sum(axis=0), mark.T @ x, mark.T @ (x * x).sum(axis=1), mark.T @ d.min(axis=1)])
        assert found[k] == pytest.approx(want, rel=1e-9, abs=1e-6)
        assert lloyd.cluster_sums(df, {k: c}, False)[k] == pytest.approx(want[:, :-2], rel=1e-9, abs=1e-6)
    compared, nearest = [], lloyd._nearest
    monkeypatch.setattr(lloyd, "_nearest", lambda ones, lifted: compared.append(len(ones)) or nearest(ones, lifted))
    monkeypatch.setattr(lloyd, "_added", lambda points, size, per_block, rows: per_block(place))
    lloyd.cluster_sums(df, {4: centers[4]}, False)
    assert sum(compared) < 0.6 * len(x)


def test_codes_over_many_partitions(spark):
    words = [f"{c}{i}" for i in range(300) for c in "zaÄé"] + ["", "A", "a"] * 5 + [None]
    df = spark.createDataFrame([(w, len(w or "") % 3) for w in words], "c string, n int").repartition(7)
    found = prep.ordinal_encode(df, ["c", "n"]).collect()
    order = sorted({w for w in words if w is not None}, key=lambda w: w.encode())
    assert len(found) == len(words)
    assert all(r.c_code == (-1.0 if r.c is None else order.index(r.c)) and r.n_code == r.n for r in found)


def test_codes_of_many_values_are_ranked_in_place(spark, monkeypatch):
    """A frequent value over many parts, missing values and text beyond ASCII; no table of values is made or joined."""
    words = [f"{c}{i}" for i in range(150) for c in "zaÄé"] + ["m"] * 3000 + [None] * 1500 + ["", "A"] * 3
    df = spark.createDataFrame([(w, i, i % 3) for i, w in enumerate(words)], "c string, i int, n int").repartition(7)
    monkeypatch.setattr(prep, "category_codes", lambda *args: pytest.fail("a table of values"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    try:
        found = prep.ordinal_encode(df, ["c", "n"], few=2)
        order = {w: float(i) for i, w in enumerate(sorted({w for w in words if w is not None}, key=lambda w: w.encode()))}
        assert found.columns == ["c", "i", "n", "c_code", "n_code"]
        rows = found.collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(r.i for r in rows) == list(range(len(words)))
    assert all(r.c == words[r.i] and r.c_code == order.get(r.c, -1.0) and r.n_code == r.n for r in rows)
    empty = prep.ordinal_encode(df.where("i < 0"), ["c"], few=-1)
    assert empty.columns == ["c", "i", "n", "c_code"] and not empty.collect()


def test_euclidean_silhouette_by_pairs(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(m, 1.0, (n, 2)) for m, n in ((0, 90), (4, 60), (9, 1))])
    label = [0] * 90 + [1] * 60 + [2]
    rows = [(f"k{i}", c, float(a), float(b)) for i, (c, (a, b)) in enumerate(zip(label, x))]
    df = spark.createDataFrame(rows + [("no", 0, None, 1.0), ("none", None, 1.0, 1.0)], "listing_id string, cluster int, a double, b double")
    d, label = np.sqrt(((x[:, None] - x) ** 2).sum(axis=2)), np.array(label)
    want = []
    for i, c in enumerate(label):
        own = (label == c) & (np.arange(len(x)) != i)
        a = d[i, own].mean() if own.any() else 0.0
        b = min(d[i, label == o].mean() for o in {0, 1, 2} - {c})
        want.append((b - a) / max(a, b) if own.any() else 0.0)
    assert tuple(segment.silhouette_euclidean(df, ["a", "b"]).first()) == pytest.approx((np.mean(want), 0.0, 151))
    value, error, scored = segment.silhouette_euclidean(df, ["a", "b"], rows=30).first()
    assert 0 < error < 0.3 and abs(value - np.mean(want)) <= error and scored == 151
    assert tuple(segment.silhouette_euclidean(df.where("a > 1000"), ["a", "b"]).first()) == (None, None, 0)


def test_euclidean_silhouette_meets_every_pair_once(spark):
    """Larger clusters than any sample, in many blocks: the mean over all pairs, without an error."""
    rng = np.random.default_rng(11)
    label = rng.choice([0, 0, 0, 1, 1, 2], 2600)
    x = (rng.normal(size=(2600, 3)) * [1, 2, 0.5] + label[:, None] * [1.5, 0, 1]).round(1) + 1000
    df = spark.createDataFrame([(f"k{i % 2500}", int(c), *map(float, p)) for i, (c, p) in enumerate(zip(label, x))],
                               "listing_id string, cluster int, a double, b double, c double").repartition(5)
    d = np.sqrt(((x[:, None] - x) ** 2).sum(axis=2))
    sums, n = np.stack([d[:, label == c].sum(axis=1) for c in range(3)], axis=1), np.bincount(label)
    a = sums[np.arange(2600), label] / (n[label] - 1)
    b = np.where(np.arange(3) == label[:, None], np.inf, sums / n).min(axis=1)
    found = segment.silhouette_euclidean(df, ["a", "b", "c"]).first()
    assert tuple(found) == pytest.approx((((b - a) / np.maximum(a, b)).mean(), 0.0, 2600), abs=1e-10)
    one, two = segment._distance_sums(x[:900], x[900:], np.eye(3)[label[:900]], np.eye(3)[label[900:]])
    assert one == pytest.approx(np.stack([d[:900, 900:][:, label[900:] == c].sum(axis=1) for c in range(3)], axis=1))
    assert two == pytest.approx(np.stack([d[900:, :900][:, label[:900] == c].sum(axis=1) for c in range(3)], axis=1))
    same = df.select("listing_id", "cluster", *[F.lit(7.5).alias(c) for c in "abc"])
    assert tuple(segment.silhouette_euclidean(same, ["a", "b", "c"]).first()) == (0.0, 0.0, 2600)
