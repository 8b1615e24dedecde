import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from tideline.operators.models import TrainSize, fit_forest_clf, fit_forest_reg, fit_gbt_clf, fit_gbt_reg
from tideline.operators.trees import Bins, Layout, Paths, Sums, Tree, _open, _slots, _walk

SIZE = TrainSize(900, trees=8, rounds=7)


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(2)
    a, b, c = rng.uniform(0, 10, 900), rng.integers(0, 4, 900), rng.normal(0, 1, 900)
    y = 12 * a + 20 * (b == 2) + rng.normal(0, 2, 900)
    rows = [tuple(map(float, r)) for r in zip(a, b, c, y, y > 70, np.digitize(y, [40, 90]))]
    df = spark.createDataFrame(rows, "a double, b double, c double, y double, flag double, kind double")
    return VectorAssembler(inputCols=["a", "b", "c"], outputCol="x").transform(df).cache()


def _fit(estimator, label, data):
    return estimator.setFeaturesCol("x").setLabelCol(label).fit(data)


def _rmse(model, data, label="y"):
    return model.transform(data).agg(
        F.sqrt(F.avg((F.col("prediction") - F.col(label)) ** 2))
    ).first()[0]


def test_regressors_are_as_good_as_those_of_spark(data):
    forest = RandomForestRegressor(numTrees=8, maxDepth=10, featureSubsetStrategy="all", seed=42)
    boost = GBTRegressor(maxIter=7, stepSize=0.08, maxDepth=4, seed=42)
    for ours, theirs, limit in ((fit_forest_reg, forest, 1.25), (fit_gbt_reg, boost, 1.05)):
        got = _fit(ours(SIZE), "y", data)
        want = theirs.setFeaturesCol("x").setLabelCol("y").fit(data)
        assert _rmse(got, data) < limit * _rmse(want, data)
        assert got.featureImportances.toArray()[0] == pytest.approx(want.featureImportances.toArray()[0], abs=0.03)


@pytest.mark.parametrize("build,label,classes", [
    (fit_forest_clf, "flag", 2), (fit_forest_clf, "kind", 3), (fit_gbt_clf, "flag", 2),
])
def test_classifiers_and_round_trip(data, tmp_path, build, label, classes):
    model = _fit(build(SIZE), label, data)
    out = model.transform(data).select(label, "prediction", "probability").collect()
    assert model.numClasses == classes and np.mean([r[0] == r[1] for r in out]) > 0.9
    assert all(len(r[2]) == classes and sum(r[2]) == pytest.approx(1) for r in out)
    PipelineModel([model]).write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m")).transform(data).select(label, "prediction", "probability")
    assert again.collect() == out


def test_one_scan_a_level(spark, data):
    """A level of all trees is one scan, however many trees there are."""
    tracker, jobs = spark.sparkContext, []
    for trees in (2, 12):
        tracker.setJobGroup(f"trees{trees}", "")
        _fit(fit_forest_reg(TrainSize(900, trees=trees)), "y", data)
        jobs.append(len(tracker.statusTracker().getJobIdsForGroup(f"trees{trees}")))
    tracker.setJobGroup("other", "other")
    assert jobs[0] == jobs[1]


def test_first_split_is_the_best_one(spark):
    rows = [(float(i), float(i % 3), 100.0 * (i >= 60)) for i in range(100)]
    df = spark.createDataFrame(rows, "a double, b double, y double")
    df = VectorAssembler(inputCols=["a", "b"], outputCol="x").transform(df)
    model = _fit(fit_gbt_reg(TrainSize(100, rounds=1)), "y", df)
    got = {r.a: r.prediction for r in model.transform(df).collect()}
    assert all(abs(got[a] - 100.0 * (a >= 60)) < 1e-9 for a in got if not 57 <= a <= 62)
    assert model.featureImportances.toArray()[0] > 0.99


@pytest.mark.parametrize("level", [0, 1, 5, 6, 7, 9, 10])
@pytest.mark.parametrize("sizes", [(7, 32, 32, 12, 5), (1, 9), (32,)])
def test_paths_and_sums_are_those_of_a_walk(level, sizes):
    """Masks of leaves lead where a walk leads, and rows of ended paths are not summed."""
    rng, inner = np.random.default_rng(level), 2**level - 1
    tree, layout = Tree.of(level, 2), Layout.of(sizes)
    tree.feature[:inner] = rng.integers(0, len(sizes), inner)
    tree.cut[:inner] = [rng.integers(0, max(1, sizes[f] - 1)) for f in tree.feature[:inner]]
    for i in range(1, inner):  # some paths end early
        if rng.random() < 0.1 or tree.feature[(i - 1) // 2] < 0:
            tree.feature[i] = -1
    cells = np.stack([rng.integers(0, n, 3000) for n in sizes]).astype(np.uint8)
    codes = layout.codes(cells)
    assert (layout.cells(codes) == cells).all()
    paths = Paths(tree.feature, tree.cut, level, layout)
    place = paths.of(codes.astype(np.intp))
    node = _walk(tree.feature, tree.cut, cells, level)
    assert (paths.ends(tree.feature)[place] == node).all()
    nodes = _open(tree, level)
    slot = _slots(nodes, level)[place]
    y, kind, w = rng.normal(size=3000), rng.integers(0, 3, 3000), rng.random(3000)
    for classes, label, columns in ((0, y, [w, w * y]), (3, kind, [w * (kind == c) for c in range(3)])):
        sums = Sums(sizes, len(nodes), classes)
        sums.add(cells, slot, label, w)
        got = sums.whole().reshape(len(sizes), len(nodes), 32, -1)
        for s, n in enumerate(nodes):
            for f in range(len(sizes)):
                want = [np.bincount(cells[f][node == n], c[node == n], 32) for c in columns]
                assert np.allclose(got[f, s], np.transpose(want))


def test_shared_bins_give_the_same_trees(data):
    bins = Bins.of(data, "x", ["flag", "y"], "a")
    for build, label in ((fit_forest_reg, "y"), (fit_gbt_reg, "y"), (fit_forest_clf, "flag"), (fit_gbt_clf, "flag")):
        alone, shared = build(SIZE), build(SIZE)
        shared.bins = bins
        if build is fit_forest_clf:
            alone.setWeightCol("a"), shared.setWeightCol("a")
        a, b = (_fit(e, label, data).featureImportances.toArray() for e in (alone, shared))
        assert np.allclose(a, b)
