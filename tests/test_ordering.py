import math
import random

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tideline.operators.association import corr_matrix
from tideline.operators.flow import (
    chrono_split, history_features, lag_corr, lag_feature, random_split, transition_matrix,
)
from tideline.operators.ordering import (
    average_rank, global_row_number, neighbour, running_total, with_ranks,
)
from tideline.operators import quantiles
from tideline.operators.quantiles import approx_quantiles, exact_quantiles, quantile_values
from tideline.session import ensure_checkpoint_dir


def frame(spark, n=400, hot=0.4, seed=1, parts=7):
    """Events of a few keys, one of which holds ``hot`` of the rows; some times are equal."""
    rng = random.Random(seed)
    rows = [(i, 0 if rng.random() < hot else rng.randint(1, 9), rng.randint(0, n // 3),
             rng.choice([None, 1.0, 2.0, 2.0, 3.5, 7.25])) for i in range(n)]
    rng.shuffle(rows)
    pdf = pd.DataFrame(rows, columns=["id", "k", "t", "x"])
    return spark.createDataFrame(rows, "id long, k int, t int, x double").repartition(parts), pdf


@pytest.mark.parametrize("parts", [1, 16])
def test_row_numbers_do_not_depend_on_partitions(spark, parts):
    df, pdf = frame(spark, parts=parts)
    got = {r.id: r.rn for r in global_row_number(df, ["t", "id"]).collect()}
    want = pdf.sort_values(["t", "id"]).id.tolist()
    assert [got[i] for i in want] == list(range(1, len(want) + 1))


def test_row_number_descending_and_empty(spark):
    df, pdf = frame(spark, 50)
    got = global_row_number(df, [F.desc("t"), F.desc("id")]).orderBy("rn").collect()
    assert [r.id for r in got] == pdf.sort_values(["t", "id"], ascending=False).id.tolist()
    assert global_row_number(df.where("false"), ["t", "id"]).count() == 0
    with pytest.raises(ValueError):
        global_row_number(df, [])


def test_running_total(spark):
    df, pdf = frame(spark)
    got = {r.id: r.total for r in running_total(df, ["t", "id"], "k").collect()}
    s = pdf.sort_values(["t", "id"])
    assert [got[i] for i in s.id] == s.k.cumsum().tolist()


@pytest.mark.parametrize("step", [-1, 1])
def test_neighbour_with_a_hot_key(spark, step):
    df, pdf = frame(spark)
    out = neighbour(df, {"near": "x"}, ["t", "id"], ["k"], step)
    got = {r.id: r.near for r in out.collect()}
    s = pdf.sort_values(["t", "id"])
    want = s.groupby("k").x.shift(-step)
    assert len(got) == len(pdf)
    for i, w in zip(s.id, want):
        assert got[i] == (None if pd.isna(w) else w)


def test_neighbour_of_ties_does_not_depend_on_partitions(spark):
    df = spark.createDataFrame([("k", 1, i) for i in range(200)], "k string, t int, id int")
    seen = [
        {r.id: r.near for r in neighbour(df.repartition(n), {"near": "id"}, ["t"], ["k"]).collect()}
        for n in (1, 7)
    ]
    assert seen[0] == seen[1]
    assert sorted(seen[0].values(), key=lambda v: -1 if v is None else v)[0] is None


def test_neighbour_without_keys(spark):
    df, pdf = frame(spark)
    got = {r.id: r.near for r in neighbour(df, {"near": "id"}, ["t", "id"]).collect()}
    s = pdf.sort_values(["t", "id"])
    assert [got[i] for i in s.id] == [None, *s.id.tolist()[:-1]]
    with pytest.raises(ValueError):
        neighbour(df, {"near": "id"}, ["t"], step=2)


def test_lag_feature_starts_with_own_value(spark):
    df = spark.createDataFrame([(1, 5), (2, 6), (3, 9)], "t int, v int")
    got = lag_feature(df, {"p": "v"}, ["t"]).orderBy("t").collect()
    assert [r.p for r in got] == [5, 5, 6]


def test_average_rank(spark):
    df, pdf = frame(spark)
    got = {(r.metric, r.value): (r.cnt, r["rank"]) for r in average_rank(df, ["x", "k"]).collect()}
    for c in ("x", "k"):
        ranks = pdf[c].rank()
        for v, g in ranks.dropna().groupby(pdf[c]):
            assert got[c, float(v)] == (len(g), g.iloc[0])
    assert len(got) == pdf.x.nunique() + pdf.k.nunique()


@pytest.mark.parametrize("limit", [10**5, 1])
def test_with_ranks_mixes_hot_and_rare_values(spark, limit):
    rng = random.Random(3)
    rows = [(i, 5.0 if i % 3 == 0 else rng.random(), None if i % 11 == 0 else float(i % 4))
            for i in range(3000)]
    pdf = pd.DataFrame(rows, columns=["id", "a", "b"])
    df = spark.createDataFrame(rows, "id long, a double, b double")
    got = {r.id: (r.a_rank, r.b_rank) for r in with_ranks(df, ["a", "b"], limit=limit).collect()}
    assert len(got) == 3000
    for i, a, b in zip(pdf.id, pdf.a.rank(), pdf.b.rank()):
        assert got[i] == (a, None if pd.isna(b) else b)


def test_spearman_against_pandas(spark):
    df, pdf = frame(spark)
    for deletion in ("listwise", "pairwise"):
        got = {(r.a, r.b): r.r for r in corr_matrix(df, ["x", "k", "t"], "spearman", deletion)
               .collect()}
        data = pdf[["x", "k", "t"]]
        want = (data.dropna() if deletion == "listwise" else data).corr("spearman").round(3)
        assert len(got) == 9
        for (a, b), r in got.items():
            assert r == pytest.approx(want.loc[a, b], abs=1.1e-3)


def test_pearson_of_constant_and_single_rows(spark):
    df = spark.createDataFrame([(1.0, 0.1), (2.0, 0.1), (4.0, 0.1)], "a double, b double")
    got = {(r.a, r.b): r.r for r in corr_matrix(df, ["a", "b"]).collect()}
    assert got == {("a", "a"): 1.0, ("a", "b"): None, ("b", "a"): None, ("b", "b"): None}
    single = corr_matrix(df.limit(1), ["a"], undefined=0.0).first()
    assert single.r == 0.0
    with pytest.raises(ValueError):
        corr_matrix(df, ["a"], "kendall")


@pytest.mark.parametrize("limit", [10**6, 20])
def test_quantiles_with_hot_values(spark, limit, monkeypatch):
    monkeypatch.setattr(quantiles, "ROW_LIMIT", limit)
    rng = np.random.default_rng(5)
    x = rng.normal(size=6000)
    x[:2000] = 0.25  # a third of the rows share a value
    y = rng.integers(0, 7, 6000).astype(float)
    rows = [(float(a), float(b), None if i % 5 else float(i)) for i, (a, b) in
            enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "x double, y double, z double").repartition(5)
    probs = [0.0, 0.01, 0.25, 0.5, 0.613, 0.75, 0.999, 1.0]
    got = quantile_values(df, ["x", "y", "z"], probs)
    z = np.array([r[2] for r in rows if r[2] is not None])
    for name, data in (("x", x), ("y", y), ("z", z)):
        for p in probs:
            assert got[name, p] == pytest.approx(np.quantile(data, p), abs=1e-12)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.none(), st.integers(-3, 3).map(float),
                          st.floats(-1e6, 1e6, allow_nan=False)), min_size=1, max_size=40),
       st.floats(0, 1))
def test_quantiles_property(spark, values, p):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    data = [v for v in values if v is not None]
    for limit in (10**6, 2):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(quantiles, "ROW_LIMIT", limit)
            got = [r.value for r in exact_quantiles(df, ["x"], [p]).collect()]
        if not data:
            assert got == []
        else:
            want = float(np.quantile(data, p))
            assert got == [pytest.approx(want, rel=1e-9, abs=1e-9)]


def test_approx_quantiles_return_existing_values(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 4, 9)], "x double")
    got = approx_quantiles(df, ["x"], [0.5]).first()
    assert (got.metric, got.prob, got.value) == ("x", 0.5, 2.0)


@pytest.mark.parametrize("kind", ["date", "int"])
@pytest.mark.parametrize("share", [0.2, 0.33, 0.5])
def test_chrono_split_with_a_hot_day(spark, kind, share):
    rng = random.Random(9)
    # two thirds of the rows fall on one day
    rows = [(i, 7 if rng.random() < 0.66 else rng.randint(0, 12)) for i in range(301)]
    df = spark.createDataFrame(rows, "id long, d int").repartition(6)
    if kind == "date":
        df = df.withColumn("d", F.date_add(F.lit("2026-01-01").cast("date"), F.col("d")))
    got = {r.id: r.split for r in chrono_split(df, ["d", "id"], share).collect()}
    order = [i for _, i in sorted((d, i) for i, d in rows)]
    cut = int(301 * (1 - share))
    assert [got[i] for i in order] == ["train"] * cut + ["test"] * (301 - cut)


def test_chrono_split_keeps_rows_without_date(spark):
    rows = [(1, None), (2, "2026-01-02"), (3, "2026-01-03"), (4, "2026-01-03"), (5, None)]
    df = spark.createDataFrame(rows, "id int, d string").withColumn("d", F.col("d").cast("date"))
    got = {r.id: r.split for r in chrono_split(df, ["d", "id"], 0.4).collect()}
    assert got == {1: "train", 5: "train", 2: "train", 3: "test", 4: "test"}


def test_random_split_is_stable(spark):
    df = spark.range(2000)
    a = {r.id: r.split for r in random_split(df.repartition(3), ["id"]).collect()}
    b = {r.id: r.split for r in random_split(df.repartition(11), ["id"]).collect()}
    assert a == b
    assert 300 < sum(s == "test" for s in a.values()) < 500
    assert a != {r.id: r.split for r in random_split(df, ["id"], seed=7).collect()}
    exact = random_split(df, ["id"], 0.1, exact=True)
    assert exact.where("split = 'test'").count() == 200


@pytest.mark.parametrize("limit", [10**6, 3])
def test_quantiles_with_nan_and_infinities(spark, limit, monkeypatch):
    monkeypatch.setattr(quantiles, "ROW_LIMIT", limit)
    inf, nan = float("inf"), float("nan")
    rows = [(nan if i % 4 == 0 else float(i), inf if i < 20 else -inf, None) for i in range(40)]
    df = spark.createDataFrame(rows, "x double, y double, z double")
    got = quantile_values(df, ["x", "y", "z"], [0.0, 0.25, 0.9, 1.0])
    x = [r[0] for r in rows if r[0] == r[0]]
    for p in (0.0, 0.25, 0.9, 1.0):
        assert got["x", p] == pytest.approx(np.quantile(x, p))
    assert [got["y", p] for p in (0.0, 0.25, 0.9, 1.0)] == [-inf, -inf, inf, inf]
    assert not [k for k in got if k[0] == "z"]


def test_lag_corr_and_transitions(spark):
    df, pdf = frame(spark)
    s = pdf.sort_values(["t", "id"]).reset_index(drop=True)
    row = lag_corr(df, "t", "x", ["t", "id"]).first()
    both = pd.DataFrame({"a": s.t, "b": s.x.shift(-1)}).dropna()
    assert row.lag_correlation == pytest.approx(both.a.corr(both.b), abs=6e-4)
    assert row.pairs == len(both)

    names = df.withColumn("state", F.concat(F.lit("s"), (F.col("id") % 3).cast("string")))
    got = {(r.from_state, r.to_state): (r.n, r.probability) for r in
           transition_matrix(names, ["k"], "state", ["t", "id"], 6).collect()}
    s["state"] = "s" + (s.id % 3).astype(str)
    s["to"] = s.groupby("k").state.shift(-1)
    want = s.dropna(subset=["to"]).groupby(["state", "to"]).size()
    assert {k: n for k, (n, _) in got.items()} == want.to_dict()
    for state in {a for a, _ in got}:
        assert math.isclose(sum(p for (a, _), (_, p) in got.items() if a == state), 1.0,
                            abs_tol=1e-5)


def test_history_features(spark):
    df, pdf = frame(spark)
    out = history_features(df, {"m": "x"}, {"p": "t"}).select("m", "p").distinct().collect()
    assert [tuple(r) for r in out] == [(round(pdf.x.mean(), 1), int(pdf.t.max()))]
    keyed = {r.k: (r.m, r.p) for r in history_features(df, {"m": "t"}, {"p": "t"}, ["k"]).collect()}
    for k, g in pdf.groupby("k"):
        assert keyed[k] == (pytest.approx(g.t.mean(), abs=0.051), g.t.max())


def test_checkpoint_dir_follows_the_session(spark):
    assert ensure_checkpoint_dir(spark) == spark.sparkContext.getCheckpointDir()
