import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tideline import presets as P
from tideline.operators.distribution import (
    box_stats, describe_stats, group_profile, group_shift, histogram, iqr_bounds, iqr_outliers,
    kde, mode_per_group, normalized_profile, rate_and_mean, trend_by, trend_by_event,
)
from tideline.operators.evaluation import (
    class_weights, classification_metrics, confusion_matrix, label_index, regression_metrics,
    select_best, standardize,
)
from tideline.operators.hypothesis import (
    TwoSample, binary_split, cohens_d, mann_whitney_u, preset_tests, two_sample_report, welch_t,
)
from tideline.operators.quantiles import quantile_values
from tideline.sources.sketches import DaySketches


@pytest.fixture(scope="module")
def sample(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame(
        {"id": range(300), "x": rng.gamma(2.0, 3.0, 300).round(1), "y": rng.normal(size=300),
         "flag": (rng.random(300) < 0.3).astype(int), "key": rng.choice(list("abc"), 300),
         "flat": 4.0}
    )
    pdf.loc[::17, "y"] = np.nan
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None).values.tolist(),
                               "id long, x double, y double, flag int, key string, flat double")
    return df.repartition(5), pdf


def test_describe(sample):
    df, pdf = sample
    got = {r.metric: r for r in describe_stats(df, ["x", "y", "flat", "absent"]).collect()}
    assert set(got) == {"x", "y", "flat"}
    for c in got:
        s, r = pdf[c].dropna(), got[c]
        assert r["count"] == s.count()
        for name, want in [("mean", s.mean()), ("std", s.std()), ("median", s.median()),
                           ("q25", s.quantile(0.25)), ("q75", s.quantile(0.75)),
                           ("iqr", s.quantile(0.75) - s.quantile(0.25)), ("min", s.min()),
                           ("max", s.max()), ("skewness", s.skew())]:
            assert r[name] == pytest.approx(round(want, 2), abs=0.011), (c, name)


def test_describe_tiny(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, 3.0)], "a double, b double")
    got = {r.metric: r for r in describe_stats(df, ["a", "b"]).collect()}
    assert (got["a"].std, got["a"].skewness) == (0.71, None)
    assert (got["b"]["count"], got["b"].std, got["b"].median) == (1, None, 3.0)


def test_trends(spark, rows):
    df = spark.createDataFrame(
        [("b", 1.0, 1), ("b", 2.0, 0), ("z", 5.0, 1), (None, 9.0, 1)], "k string, x double, f int")
    assert rows(trend_by(df, "k", ["x"], ["a", "b"]), "ord", "k", "x") == [
        (0, "a", 0.0), (1, "b", 1.5)]
    assert rows(trend_by(df, "f", ["x"])) == [(0, 2.0), (1, 5.0)]
    out = trend_by_event(df, "f", ["x"])
    assert rows(out, "status", "x") == [("Campus Event", 5.0), ("No Event", 2.0)]
    assert rows(normalized_profile(df, "k", {"x": 8}, ["b", "q"]), "k", "x") == [
        ("b", 18.8), ("q", None)]


def test_outliers(spark, rows):
    values = [10.0] * 5 + [12.0] * 5 + [11.0] * 5 + [99.0, -50.0, None]
    data = [(i, v, int(v == 99.0), 0) for i, v in enumerate(values)]
    df = spark.createDataFrame(data, "record_id int, v double, tournament_flag int, is_exam_week int")
    b = iqr_bounds(df, ["v"]).first()
    s = pd.Series(values).dropna()
    q1, q3 = s.quantile(0.25), s.quantile(0.75)
    assert (b.q25, b.q75, b.outlier_count) == (q1, q3, 2)
    assert (b.lower_bound, b.upper_bound) == (q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1))
    assert iqr_bounds(df, ["v"], 20, floor_zero=True).first().lower_bound == 0.0
    got = iqr_outliers(df, "v", keep=["record_id"])
    assert rows(got, "record_id", "value", "event_context") == [
        (15, 99.0, "Sports Tournament Event"), (16, -50.0, P.OUTLIER_OTHER)]
    box = box_stats(df, ["v"]).first()
    assert (box.whisker_low, box.whisker_high, box.fliers) == (10.0, 12.0, 2)


def test_histogram_and_kde(sample):
    df, pdf = sample
    counts, edges = np.histogram(pdf.x, 20)
    got = histogram(df, "x").orderBy("bin").collect()
    assert [r["count"] for r in got] == counts.tolist()
    assert [r.left_edge for r in got] == pytest.approx(edges[:-1])
    assert sum(r.density for r in got) * (edges[1] - edges[0]) == pytest.approx(1.0)
    flat = histogram(df, "flat", 4).orderBy("bin").collect()
    assert [r["count"] for r in flat] == np.histogram(pdf.flat, 4)[0].tolist()

    x = pdf.x.to_numpy()
    h = x.std(ddof=1) * len(x) ** -0.2
    grid = np.linspace(x.min(), x.max(), 200)
    want = np.exp(-0.5 * ((grid[:, None] - x) / h) ** 2).sum(1) / (len(x) * h * math.sqrt(2 * math.pi))
    dense = kde(df, "x").orderBy("point").collect()
    assert [r.density for r in dense] == pytest.approx(want)
    for c in ("flat",):
        with pytest.raises(ValueError):
            kde(df, c)


def test_kde_bins_instead_of_values(spark):
    n, resolution = 200_000, 0.02
    df = spark.range(n).select((F.randn(5) + F.when(F.col("id") % 3 == 0, 4).otherwise(0)).alias("x")).cache()
    x = np.sort(df.toPandas().x.to_numpy())
    h = x.std(ddof=1) * n ** -0.2
    grid = np.linspace(x[0], x[-1], 50)
    want = [np.exp(-0.5 * ((g - x) / h) ** 2).sum() / (n * h * math.sqrt(2 * math.pi)) for g in grid]
    out = kde(df, "x", 50, resolution=resolution)
    got = [r.density for r in out.orderBy("point").collect()]
    bound = 0.23 * resolution ** 3 / (h * math.sqrt(2 * math.pi))
    assert max(abs(a - b) for a, b in zip(got, want)) < bound
    # what moves first is at most a row per bin and task
    assert len(np.unique(np.floor((x - x[0]) / (h * resolution)))) < n / 20
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(bin") == 1 and "hashpartitioning(value" not in plan
    df.unpersist()


def test_modes_and_rates(spark, rows):
    df = spark.createDataFrame(
        [(1, "b"), (1, "a"), (1, None), (1, None), (2, "c"), (2, "c"), (2, "a")], "g int, s string")
    assert rows(mode_per_group(df, ["g"], "s")) == [(1, "a"), (2, "c")]
    r = rate_and_mean(df.withColumn("f", (F.col("g") == 1).cast("int")), "f", "g").first()
    assert tuple(r) == (7, 57.1, 1.43)
    shift = group_shift(df.withColumn("f", (F.col("g") == 1).cast("int")), "f", {"d": "g"})
    assert shift.first().d == -1.0


def test_group_profile_personas(spark):
    cols = ("cluster int, sports_load_pct double, food_orders_demand double, library_load_pct "
            "double, campus_pulse_index double, is_exam_week int, campus_event_flag int, "
            "time_slot string")
    data = [(0, 90.0, 10.0, 5.0, 5.0, 1, 1, "Night"), (1, 90.0, 10.0, 5.0, 5.0, 0, 1, "Night"),
            (2, 10.0, 181.0, 5.0, 5.0, 0, 0, "Night"), (3, 10.0, 10.0, 5.0, 5.0, 0, 1, "Night"),
            (4, 10.0, 10.0, 5.0, 5.0, 0, 0, "Noon"), (4, 20.0, 10.0, None, 5.0, 0, 0, "Morning")]
    got = {r.cluster: r for r in group_profile(spark.createDataFrame(data, cols)).collect()}
    keys = ["exam", "sports", "event", "event", "calm"]
    assert [got[i].label for i in range(5)] == [P.PERSONAS[k][0] for k in keys]
    assert (got[4].sample_count, got[4].percentage_of_data) == (2, 33.3)
    assert (got[4].avg_sports_load_pct, got[4].avg_library_load_pct) == (15.0, 5.0)
    assert got[4].predominant_time_slot == "Morning"


def _welch(a, b):
    va, vb = a.var(ddof=1) / len(a), b.var(ddof=1) / len(b)
    t = (a.mean() - b.mean()) / math.sqrt(va + vb)
    return t, (va + vb) ** 2 / (va**2 / (len(a) - 1) + vb**2 / (len(b) - 1))


def test_two_samples(sample):
    df, pdf = sample
    tests = [binary_split("y", "y", "flag"), TwoSample("x", "x", F.col("key") == "a",
                                                       F.col("key") == "b", "A", "B")]
    groups = {"y": (pdf[pdf.flag == 1].y.dropna(), pdf[pdf.flag == 0].y.dropna()),
              "x": (pdf[pdf.key == "a"].x, pdf[pdf.key == "b"].x)}
    t = {r.test: r for r in welch_t(df, tests).collect()}
    u = {r.test: r for r in mann_whitney_u(df, tests).collect()}
    d = {r.test: r for r in cohens_d(df, tests).collect()}
    report = {r.test: r for r in two_sample_report(df, tests).collect()}
    for name, (a, b) in groups.items():
        stat, free = _welch(a, b)
        assert t[name].t_statistic == pytest.approx(stat, abs=6e-5)
        assert t[name].df == pytest.approx(free, abs=6e-5)
        ranks = pd.concat([a, b]).rank()
        want = ranks.iloc[: len(a)].sum() - len(a) * (len(a) + 1) / 2
        assert u[name].mann_whitney_u == want
        pooled = math.sqrt(((len(a) - 1) * a.var() + (len(b) - 1) * b.var()) / (len(a) + len(b) - 2))
        assert d[name].cohens_d == pytest.approx((a.mean() - b.mean()) / pooled, abs=6e-4)
        assert report[name].sample_a_label.endswith(f"(N={len(a)})")
        assert report[name].statistically_significant == (report[name].p_value_ttest < 0.05)
        assert report[name].conclusion.startswith(
            "Reject" if report[name].statistically_significant else "Fail")


def test_two_samples_at_the_edges(spark):
    df = spark.createDataFrame([(1, 5.0), (1, 5.0), (0, 5.0), (0, 5.0)], "flag int, v double")
    r = two_sample_report(df, [binary_split("same", "v", "flag")]).first()
    assert (r.t_statistic, r.p_value_ttest, r.cohens_d) == (None, None, 0.0)
    assert (r.mann_whitney_u, r.statistically_significant) == (2.0, False)
    one_sided = two_sample_report(df.where("flag = 1"), [binary_split("none", "v", "flag")]).first()
    assert (one_sided.sample_b_label, one_sided.mann_whitney_u) == ("B (N=0)", None)
    small = spark.createDataFrame([(1, 1.0), (1, 2.0), (1, 3.0), (0, 4.0), (0, 5.0), (0, 6.0)],
                                  "flag int, v double")
    exact = mann_whitney_u(small, [binary_split("exact", "v", "flag")]).first()
    assert (exact.mann_whitney_u, exact.p_value_mwu) == (0.0, 0.1)


def test_preset_tests_name_canonical_columns(spark):
    assert [t.name for t in preset_tests()][:3] == ["exam_sports", "exam_library", "event_food"]
    assert len(preset_tests()) == 6


def test_published_confusion_matrix(spark, rows):
    cells = [(0, 0, 82), (0, 1, 7), (1, 0, 1), (1, 1, 8)]
    data = [(y, p) for y, p, n in cells for _ in range(n)]
    df = spark.createDataFrame(data, "label int, prediction int")
    m = classification_metrics(df).first()
    assert (m.accuracy, m.precision, m.recall, m.f1) == (0.9184, 0.5333, 0.8889, 0.6667)
    assert rows(confusion_matrix(df, zeros=True)) == cells
    assert rows(confusion_matrix(df)) == [c for c in cells if c[2]]


def test_classification_edges(spark, rows):
    df = spark.createDataFrame([("a", "a"), ("b", "c"), ("b", "b"), ("b", "a")],
                               "label string, prediction string")
    w = classification_metrics(df, average="weighted").first()
    # a: p 1/2 r 1 f 2/3; b: p 1 r 1/3 f 1/2; c has no labels
    assert tuple(w) == (4, 0.5, 0.875, 0.5, round((2 / 3 + 1.5) / 4, 4))
    assert len(confusion_matrix(df, zeros=True).collect()) == 9
    none = classification_metrics(spark.createDataFrame([(0, 0)], "label int, prediction int"))
    assert tuple(none.first()) == (1, 1.0, 0.0, 0.0, 0.0)
    with pytest.raises(ValueError):
        classification_metrics(df, average="micro")


def test_regression_metrics(sample):
    df, pdf = sample
    p = df.withColumn("prediction", F.col("x") * 0.9 + 0.3).withColumn("label", F.col("x"))
    r = regression_metrics(p).first()
    e = pdf.x - (pdf.x * 0.9 + 0.3)
    assert r.mae == pytest.approx(e.abs().mean(), abs=6e-3)
    assert r.rmse == pytest.approx(math.sqrt((e**2).mean()), abs=6e-3)
    assert r.r2 == pytest.approx(1 - (e**2).sum() / ((pdf.x - pdf.x.mean()) ** 2).sum(), abs=6e-5)
    flat = df.select(F.col("flat").alias("label"), F.col("flat").alias("prediction"))
    assert regression_metrics(flat).first().r2 == 1.0


def test_labels_weights_scaling_and_choice(spark, rows):
    a = spark.createDataFrame([("x",), ("x",), (None,), ("y",)], "l string")
    b = spark.createDataFrame([("w",)], "l string")
    assert rows(label_index(a, b, "l")) == [(0, "w"), (1, "x"), (2, "y")]
    assert rows(label_index(b, b, "l", ("w", "q"))) == [(0, "q"), (1, "w")]
    assert rows(class_weights(a, "l"), "l", "weight") == [("x", 0.75), ("y", 1.5)]
    z = standardize(spark.createDataFrame([(1.0, 7), (3.0, 7)], "v double, c int"), ["v", "c"])
    assert rows(z, "v_z", "c_z") == [(-1.0, 0.0), (1.0, 0.0)]
    scores = spark.createDataFrame([("a", 0, 0.5), ("b", 1, 0.9), ("c", 2, 0.9)],
                                   "candidate string, ord int, s double")
    assert select_best(scores, "s").first().best == "b"


def test_day_sketches(spark, tmp_path):
    import datetime as dt

    rng = np.random.default_rng(6)
    days = [dt.date(2026, 1, 1) + dt.timedelta(i) for i in range(5)]
    data = [(d, float(v) if v > -1 else None, float(k)) for i, d in enumerate(days)
            for v, k in zip(rng.normal(i, 1, 400), rng.integers(0, 3, 400))]
    data += [(None, 99.0, 1.0), (days[0], float("nan"), 1.0)]
    df = spark.createDataFrame(data, "d date, x double, k double")
    store = DaySketches(spark, str(tmp_path / "s"), ["x", "k"], size=64)
    store.add(df.where(F.col("d") < "2026-01-04"), "d")
    files = lambda: {str(p): p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet")}
    before = files()
    late = df.where((F.col("d") >= "2026-01-04") | F.col("d").isNull())
    store.add(late, "d")
    store.add(late, "d")  # again: nothing counts twice
    assert before.items() <= files().items()  # a new day touches no other
    sizes = {r.metric: r.n for r in store.merged().collect()}
    x = np.array([r[1] for r in data if r[1] is not None and r[1] == r[1]])
    assert sizes == {"x": len(x), "k": len(data)}
    probs = [0.0, 0.1, 0.5, 0.99, 1.0]
    got = {(r.metric, r.prob): r.value for r in store.exact(df, probs).collect()}
    for p in probs:
        assert got["x", p] == pytest.approx(np.quantile(x, p))
        assert got["k", p] == pytest.approx(np.quantile([r[2] for r in data], p))
    near = {(r.metric, r.prob): r.value for r in store.approximate([0.5], "2026-01-02", "2026-01-04").collect()}
    mid = np.array([r[1] for r in data if r[0] in days[1:4] and r[1] is not None])
    assert abs((mid <= near["x", 0.5]).mean() - 0.5) < 0.06
    # rows that no sketch knows: still exact
    more = df.unionByName(spark.createDataFrame([(days[0], 50.0, 7.0)] * 300, df.schema))
    fresh = {(r.metric, r.prob): r.value for r in store.exact(more, [0.9]).collect()}
    assert fresh["x", 0.9] == pytest.approx(np.quantile(np.r_[x, [50.0] * 300], 0.9))
    empty = DaySketches(spark, str(tmp_path / "none"), ["x"])
    assert empty.exact(df.select("x"), [0.5]).count() == 1


def test_shared_quartiles_give_the_same(spark):
    df = spark.range(100).selectExpr("CAST(id AS DOUBLE) * id AS x", "CAST(NULL AS DOUBLE) AS y")
    known = quantile_values(df, ["x", "y"], (0.25, 0.5, 0.75))
    for make in (lambda **k: describe_stats(df, ["x", "y"], **k), lambda **k: iqr_bounds(df, ["x", "y"], **k)):
        assert sorted(map(str, make().collect())) == sorted(map(str, make(known=known).collect()))
