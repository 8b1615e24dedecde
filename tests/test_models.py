import json
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from tideline import presets as P
from tideline.operators.clusters import (
    CLUSTER, ClusterSuite, assign_cluster, block_count, calinski_harabasz, cluster_pipeline, cluster_points,
    cluster_profiles, inertia, kmeans_fit, kmeans_sweep, load_clusters, nearest_centre,
    pca_project, save_clusters, silhouette_euclidean, silhouette_squared, vectors,
)
from tideline.operators.lloyd import fit_from, packed
from tideline.operators.models import (
    CLASSIFIERS, FOOD_SUITE, LIBRARY_SUITE, REGRESSORS, SPORTS_SUITE, SuiteSpec,
    feature_importance, fit_logistic, load_suite, save_suite, train_suite, TrainSize,
)
from tideline.operators.stages import fit_scale
from tideline.operators.trees import Bins
from tideline.session import stable

SMALL = dict(trees=10, rounds=8)
FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def signal(spark):
    rng = np.random.default_rng(4)
    a, b = rng.uniform(0, 10, 600), rng.integers(0, 4, 600)
    y = 12 * a + 20 * (b == 2) + rng.normal(0, 2, 600)
    rows = [(i, float(a[i]), int(b[i]), 1.0, float(y[i]), int(y[i] > 80),
             "hi" if y[i] > 90 else "lo" if y[i] < 40 else "mid") for i in range(600)]
    df = spark.createDataFrame(
        rows, "id int, a double, b int, c double, y double, flag int, kind string")
    return df.where("id < 480").cache(), df.where("id >= 480").cache()


@pytest.fixture(scope="module")
def suite(signal):
    spec = SuiteSpec("s", FEATURES, "y", "flag", (0, 300), 0.0, classifiers=tuple(CLASSIFIERS),
                     **SMALL)
    return train_suite(*signal, spec)


def test_planted_signal_is_found(suite, spark):
    report = {r.candidate: r for r in suite.report_frame(spark).collect()}
    assert set(report) == {c.name for c in [*REGRESSORS, *CLASSIFIERS]}
    assert report[suite.best_regressor].r2 > 0.85
    assert report[suite.best_classifier].accuracy > 0.85
    assert report["Linear Regression"].r2 > 0.9
    assert sum(r.is_best for r in report.values()) == 2
    assert sum(map(sum, json.loads(report["Logistic Regression"].confusion))) == 120


def test_predictions_of_contexts(suite, spark, signal):
    _, test = signal
    out = suite.predict(test)
    assert set(out.columns) == {*test.columns, "predicted_value", "predicted_class", "probability"}
    assert out.where("abs(predicted_value - y) < 25").count() > 110
    assert out.where("probability between 0 and 1").count() == 120
    partial = spark.createDataFrame([(5.0, None), (0.0, 0)], "a double, b int")
    scored = suite.predict(partial).collect()
    assert all(r.predicted_value >= 0.0 for r in scored)


def test_importances(suite, spark):
    forest = feature_importance(spark, suite, "Random Forest Regressor").collect()
    assert [r.feature for r in forest][0] == "a" and forest[-1].importance == 0.0
    assert sum(r.importance for r in forest) == pytest.approx(1.0, abs=1e-3)
    weights = {r.feature: r.importance
               for r in feature_importance(spark, suite, "Logistic Regression").collect()}
    assert weights["a"] > 1 and weights["c"] == 0.0


def test_multiclass_and_round_trip(signal, spark, tmp_path):
    spec = SuiteSpec("k", FEATURES, "y", "kind", (10, 500), 10.0, "weighted",
                     regressors=tuple(REGRESSORS[:1]), classifiers=tuple(CLASSIFIERS[:2]), **SMALL)
    fitted = train_suite(*signal, spec)
    assert fitted.classes == ["hi", "lo", "mid"]
    path = save_suite(spark, fitted, str(tmp_path / "suite"))
    loaded = load_suite(spark, spec, path)
    assert loaded.best_classifier == fitted.best_classifier
    pick = lambda s: [tuple(r) for r in s.predict(signal[1]).select(
        "id", "predicted_value", "predicted_class").orderBy("id").collect()]
    assert pick(loaded) == pick(fitted)


def test_one_class_is_not_fitted(signal, spark):
    train, test = (d.withColumn("flag", F.lit(0)) for d in signal)
    spec = SuiteSpec("one", FEATURES, "y", "flag", regressors=tuple(REGRESSORS[:1]), **SMALL)
    fitted = train_suite(train, test, spec)
    assert fitted.degenerate and fitted.best_classifier == "Random Forest Classifier"
    report = [r for r in fitted.report if r["kind"] == "classification"]
    assert all(r["accuracy"] == r["f1"] == 1.0 and r["confusion"] == "[[120]]" for r in report)
    assert {r.predicted_class for r in fitted.predict(test).collect()} == {0}


def test_suites_use_canonical_columns():
    for spec, n in ((SPORTS_SUITE, 22), (FOOD_SUITE, 13), (LIBRARY_SUITE, 13)):
        assert len(spec.features) == n
    assert len(P.CLUSTER_FEATURES) == 9
    assert len(SPORTS_SUITE.classifiers) == 3 and len(FOOD_SUITE.classifiers) == 2
    assert replace(SPORTS_SUITE, trees=5).trees == 5


def test_logistic_penalty_is_that_of_a_summed_loss(spark):
    # minimise sum of log losses + w^2/2 on population z-scores, by Newton steps
    rng = np.random.default_rng(8)
    x = rng.normal(3, 2, 80)
    y = (x + rng.normal(0, 2, 80) > 3).astype(float)
    z = np.column_stack([(x - x.mean()) / x.std(), np.ones(80)])
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-z @ w))
        grad = z.T @ (p - y) + np.array([w[0], 0])
        hess = (z * (p * (1 - p))[:, None]).T @ z + np.diag([1.0, 0.0])
        w -= np.linalg.solve(hess, grad)
    df = spark.createDataFrame([(float(a), int(b), float(b)) for a, b in zip(x, y)],
                               "x double, l int, y double")
    spec = SuiteSpec("l", ["x"], "y", "l", regressors=tuple(REGRESSORS[:1]),
                     classifiers=tuple(CLASSIFIERS[:1]))
    fitted = train_suite(df, df, spec)
    model = fitted.models["Logistic Regression"]
    scale = np.sqrt(79 / 80)  # from weights on sample z-scores to those on population ones
    assert model.coefficients[0] * scale == pytest.approx(w[0], rel=1e-3)
    assert model.intercept == pytest.approx(w[1], abs=2e-3)
    assert fit_logistic(TrainSize(80)).getRegParam() == pytest.approx(79 / 6400)


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(6)
    centres = [(0, 0), (20, 0), (0, 20)]
    rows = []
    for i in range(240):
        c = i % 3
        rows.append((i, c, float(rng.normal(centres[c][0])), float(rng.normal(centres[c][1])), 3.0,
                     "Noon" if c else "Night"))
    return spark.createDataFrame(rows, "id int, truth int, x double, y double, flat double, slot string")


def silhouette(points, labels, power=1):
    out = []
    for p, c in zip(points, labels):
        d = np.sqrt(((points - p) ** 2).sum(1)) ** power
        own = labels == c
        if own.sum() == 1:
            out.append(0.0)
            continue
        a = d[own].sum() / (own.sum() - 1)
        b = min(d[labels == o].mean() for o in set(labels) - {c})
        out.append((b - a) / max(a, b))
    return np.mean(out)


@pytest.mark.parametrize("block_rows", [4096, 25])
def test_silhouettes(spark, blobs, block_rows):
    df = blobs.withColumn("truth", F.when(F.col("id") == 5, 9).otherwise(F.col("truth")))
    df = df.withColumn("p", F.array("x", "y"))
    pdf = df.toPandas()
    points, labels = pdf[["x", "y"]].to_numpy(), pdf.truth.to_numpy()
    got = silhouette_euclidean(df, "id", "truth", "p", None, block_rows).first()[0]
    assert got == pytest.approx(silhouette(points, labels))
    if block_rows > 100:
        from pyspark.ml.functions import array_to_vector
        sq = silhouette_squared(df.withColumn("v", array_to_vector("p")), "truth", "v", None)
        assert sq.first()[0] == pytest.approx(silhouette(points, labels, 2))


def test_silhouette_moves_few_copies(spark, blobs):
    # a point is moved once per block; blocks of a fixed 2,048 rows would be 293
    assert block_count(600_000, 64, 10, 12) == 10
    assert block_count(100_000, 64, 10, 12) == 6 and block_count(500, 64, 10, 12) == 1
    assert block_count(600_000, 4096, 10, 12) == block_count(600_000, 64, 100_000, 12) == 293
    # without a label a point has no silhouette and belongs to no cluster
    df = blobs.withColumn("p", F.array("x", "y"))
    gaps = df.withColumn("truth", F.when(F.col("id") % 5 > 0, F.col("truth")))
    pdf = gaps.where("truth IS NOT NULL").toPandas()
    want = silhouette(pdf[["x", "y"]].to_numpy(), pdf.truth.to_numpy())
    assert silhouette_euclidean(gaps, "id", "truth", "p", None).first()[0] == pytest.approx(want)
    assert silhouette_euclidean(gaps.limit(0), "id", "truth", "p").first()[0] is None


def test_sums_of_squares(blobs):
    pdf = blobs.toPandas()
    p, l = pdf[["x", "y"]], pdf.truth
    w = sum(((p[l == c] - p[l == c].mean()) ** 2).sum().sum() for c in range(3))
    b = sum((l == c).sum() * ((p[l == c].mean() - p.mean()) ** 2).sum() for c in range(3))
    assert inertia(blobs, "truth", ["x", "y"]).first()[0] == pytest.approx(w, abs=6e-3)
    ch = calinski_harabasz(blobs, "truth", ["x", "y"]).first()[0]
    assert ch == pytest.approx((b / 2) / (w / 237), rel=1e-5)


@pytest.mark.parametrize("method", ["euclidean", "squared"])
def test_sweep_finds_planted_clusters(spark, blobs, method):
    sweep = kmeans_sweep(blobs, "id", ["x", "y", "flat"], 2, 4, restarts=3, silhouette=method)
    assert sweep.best_k == 3
    assert [r.k for r in sweep.frame(spark).collect() if r.is_best] == [3]
    placed = sweep.model.transform(vectors(blobs, ["x", "y", "flat"]))
    pairs = placed.select("truth", CLUSTER).distinct().collect()
    assert len(pairs) == 3
    if method == "squared":
        return
    profiles = cluster_profiles(
        placed.withColumn("zero", F.lit(0)), sports="x", food="y", library="x", index="y",
        exam="zero", event="zero", slot="slot")
    assert sorted(r.sample_count for r in profiles.collect()) == [80, 80, 80]
    projection = pca_project(placed)
    assert sum(projection.variance) == pytest.approx(1.0, abs=1e-3)
    points = cluster_points(placed, profiles, projection, ["id"], ["id"], 20)
    assert points.count() == 20 and "cluster_name" in points.columns
    new = spark.createDataFrame([(20.0, 0.0), (0.0, 20.0), (0.0, 0.0)], "x double, y double")
    out = assign_cluster(new, ["x", "y", "flat"], blobs, sweep.model, profiles.limit(0), projection)
    assert len({r[CLUSTER] for r in out.collect()}) == 3
    assert {r.label for r in out.collect()} == {P.UNKNOWN_PERSONA}


def test_customers_are_joined_once(spark, sf):
    from tideline.catalogue import grouping

    # one table, written: no pass of a query reads the orders again
    assert grouping._customers(spark, sf) is grouping._customers(spark, sf)
    assert grouping._placed(spark, sf).inputFiles() == []


def test_sweep_rejects_unknown_scores(blobs):
    with pytest.raises(ValueError):
        kmeans_sweep(blobs, "id", ["x"], silhouette="cosine")


def test_saved_clusters_place_rows_alike(spark, blobs, tmp_path):
    features = ["x", "y", "flat", "absent"]
    scale = fit_scale(blobs, features)
    model = kmeans_fit(scale.transform(blobs), 3, restarts=3)
    placed = model.transform(scale.transform(blobs))
    projection = pca_project(placed, 2)
    profiles = spark.createDataFrame(
        [(c, f"name {c}", "text", "do") for c in range(2)],
        "cluster int, label string, description string, recommended_action string")
    suite = ClusterSuite(cluster_pipeline(scale, model, profiles, projection), [{"k": 3}], 3, [0.5])
    save_clusters(spark, suite, str(tmp_path / "c"))
    loaded = load_clusters(spark, str(tmp_path / "c"))
    assert (loaded.scores, loaded.best_k, loaded.variance) == ([{"k": 3}], 3, [0.5])
    new = blobs.drop("flat").withColumn("x", F.when(F.col("id") % 7 != 0, F.col("x")))
    a, b = suite.assign(new), loaded.assign(new)
    assert a.columns == b.columns and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    direct = assign_cluster(new, features, blobs, model, profiles, projection).select(a.columns)
    assert direct.exceptAll(b).count() == 0
    assert P.UNKNOWN_PERSONA in {r.label for r in b.collect()}


def test_all_fits_share_their_scans(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(c, 0.3, (60, 2)) for c in ((0, 0), (6, 0), (0, 6))])
    points = spark.createDataFrame([(p.tolist(),) for p in x], "point array<double>").repartition(3)
    points = stable(points)  # as the operators do, so that a scan is no shuffle of its own
    starts = [x[:2], x[[0, 70, 130]], x[[5, 6, 7]], np.array([[0.0, 0.0], [99.0, 99.0]])]
    tracker, group = spark.sparkContext, "lloyd"
    tracker.setJobGroup(group, group)
    fits = fit_from(points, starts, tol=1e-9)
    jobs = len(tracker.statusTracker().getJobIdsForGroup(group))
    tracker.setJobGroup("other", "other")
    for start, fit in zip(starts, fits):
        c = np.array(start, float)
        for _ in range(fit.rounds):
            near = ((x[:, None] - c[None]) ** 2).sum(2).argmin(1)
            c = np.array([x[near == k].mean(0) if (near == k).any() else c[k] for k in range(len(c))])
        assert np.allclose(fit.centres, c)
        assert fit.cost == pytest.approx(((x[:, None] - c[None]) ** 2).sum(2).min(1).sum())
    assert fits[3].centres[1].tolist() == [99.0, 99.0]  # a centre without rows stays
    scans = max(f.rounds for f in fits) + 1
    # a scan is two jobs, its partial sums and what adds them up; fit by fit there would be more
    assert jobs <= 2 * scans < 2 * sum(f.rounds + 1 for f in fits)


def test_rounds_are_one_even_job(spark):
    x = np.random.default_rng(5).normal(size=(900, 3))
    points = stable(spark.createDataFrame([(p.tolist(),) for p in x], "point array<double>").coalesce(1))
    blocks = packed(points, len(x))
    per_task = blocks.rdd.glom().map(lambda part: sum(len(r.block) // 24 for r in part)).collect()
    assert sum(per_task) == 900 and len(per_task) > 1 and max(per_task) <= 2 * min(per_task)
    starts = [x[:3], x[[3, 3, 9]]]
    tracker = spark.sparkContext
    tracker.setJobGroup("packed", "packed")
    fits = fit_from(blocks, starts, rounds=4, tol=0.0)
    jobs = len(tracker.statusTracker().getJobIdsForGroup("packed"))
    tracker.setJobGroup("other", "other")
    assert jobs == 5  # four rounds and the costs
    for a, b in zip(fits, fit_from(points, starts, rounds=4, tol=0.0)):
        assert np.allclose(a.centres, b.centres) and a.cost == pytest.approx(b.cost)
    # of equal centres the first takes the rows, the other stays
    assert fit_from(blocks, starts[1:], rounds=1)[0].centres[1].tolist() == x[3].tolist()


def test_nearest_centre(spark, rows):
    df = spark.createDataFrame([(0.0, 0.0), (9.0, 1.0), (5.0, 0.0)], "x double, y double")
    out = nearest_centre(df, ["x", "y"], {0: (0, 0), 1: (10, 0)})
    assert rows(out, "x", CLUSTER) == [(0.0, 0), (5.0, 0), (9.0, 1)]


def test_suites_of_the_same_rows_share_regressors(signal, suite, spark):
    spec = SuiteSpec("t", FEATURES, "y", "kind", (10, 300), 10.0, "weighted", extra_classes=("lo", "hi"), **SMALL)
    alone, sharing = train_suite(*signal, spec), train_suite(*signal, spec, [suite])
    for c in REGRESSORS:
        assert sharing.models[c.name] is suite.models[c.name] and alone.models[c.name] is not suite.models[c.name]
    assert list(sharing.models) == list(alone.models) and sharing.report == alone.report
    # other features or rounds are other models
    for change in ({"features": ["a", "b"]}, {"rounds": 3}, {"target": "a"}):
        other = train_suite(*signal, replace(spec, label=None, regressors=tuple(REGRESSORS[:1]), **change), [suite])
        assert other.models["Linear Regression"] is not suite.models["Linear Regression"]


def test_ensembles_of_a_suite_bin_their_rows_once(signal, monkeypatch):
    calls, real = [], Bins.of
    monkeypatch.setattr(Bins, "of", lambda df, *given: calls.append(given[1]) or real(df, *given))
    train, test = signal
    spec = SuiteSpec("u", FEATURES, "y", "flag", classifiers=tuple(CLASSIFIERS[1:]), trees=2, rounds=2)
    train_suite(train, test, spec)
    assert calls == [["_class", "_target"]]
    # rows without a label count for the other one
    calls.clear()
    unlabelled = train.withColumn("flag", F.when(F.col("id") > 9, F.col("flag")))
    train_suite(unlabelled, test, spec)
    assert sorted(calls) == [["_class"], ["_class"], ["_target"]]
