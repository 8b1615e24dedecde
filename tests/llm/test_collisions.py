"""Near-duplicate vectors against all pairs."""

import math

import numpy as np
import pytest

from tideline.llm.collisions import cosines, fit_lists, near_vectors

SCHEMA = "vec_id long, embedding array<double>, label int, node long, sound boolean, v string"


def answer(spark, rows, schema=SCHEMA, **how):
    df = spark.createDataFrame([(i, v, 1, 2, False, "x") for i, v in rows], schema).repartition(3)
    out = near_vectors(df, **how)
    assert out.columns == ["vec_id", "n_links", "component_id", "kept"]
    return sorted((tuple(r) for r in out.collect()), key=str)


def brute(rows, threshold=0.9):
    n, links = len(rows), [0] * len(rows)
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    fit = [i for i, (_, v) in enumerate(rows)
           if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    for length in {len(rows[i][1]) for i in fit}:
        own = [i for i in fit if len(rows[i][1]) == length]
        x = np.array([rows[i][1] for i in own], float)
        for k, i in enumerate(own):
            cos = cosines(np.broadcast_to(x[k], x.shape), x) >= threshold
            cos[k] = False
            links[i] = int(cos.sum())
            for j in np.flatnonzero(cos):
                root[find(own[j])] = find(i)
    least = {}
    for i, (name, _) in enumerate(rows):
        if name is not None:
            r = find(i)
            least[r] = min(name, least.get(r, name))
    out = []
    for i, (name, _) in enumerate(rows):
        c = least.get(find(i))
        out.append((name, links[i], c, name is None or name == c))
    return sorted(out, key=str)


def around(centre, n, spread, rng):
    return centre + spread * np.linalg.norm(centre) * rng.normal(size=(n, len(centre))) / math.sqrt(len(centre))


def test_families_chains_and_strangers(spark):
    rng = np.random.default_rng(5)
    tight = around(rng.normal(size=24), 300, 0.1, rng)
    wide = around(rng.normal(size=24), 250, 0.33, rng)  # radii leave pairs open
    equal = np.repeat(rng.normal(size=(1, 24)), 200, axis=0)
    chain = [rng.normal(size=24)]
    for _ in range(30):  # each links with its neighbours at most
        step = rng.normal(size=24)
        chain.append(chain[-1] / np.linalg.norm(chain[-1]) + 0.35 * step / np.linalg.norm(step))
    x = np.r_[tight, wide, 7.0 * equal, np.array(chain), rng.normal(size=(600, 24))]
    ids = rng.permutation(len(x)).tolist()
    rows = [(i, v.tolist()) for i, v in zip(ids, x)]
    got, want = answer(spark, rows), brute(rows)
    over = sum(max(0, g[1] - w[1]) for g, w in zip(got, want))
    assert over == 0  # never a link below the threshold
    assert sum(g[1] for g in got) >= 0.98 * sum(w[1] for w in want)
    assert np.mean([g[2] == w[2] for g, w in zip(got, want)]) > 0.98
    sure = {i for i in ids[:300]} | {i for i in ids[550:750]}  # far above the threshold: all links
    assert [g for g in got if g[0] in sure] == [w for w in want if w[0] in sure]


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0, 0.0]), (2, [2.0, 0.0, 0.0]), (2, [2.0, 0.0, 0.0]), (2, [0.0, 1.0, 0.0]),
        (3, None), (4, []), (5, [0.0, 0.0, 0.0]), (6, [nan, 1.0, 0.0]), (7, [inf, 0.0, 0.0]),
        (8, [None, 1.0, 0.0]), (9, [1.0, 0.0]), (10, [1e-320, 0.0, 0.0]), (11, [1e300, 1e299, 0.0]),
        (None, [0.0, 0.0, -3.0]), (None, [0.0, 0.0, -4.0]), (None, [0.0, 1.0, 0.0]), (None, None),
        (12, [5.0]), (13, [7.0]), (14, [-7.0]), (15, [-1.0, 0.0, 0.0]),
    ]
    assert answer(spark, rows) == brute(rows)


def test_empty_and_single(spark):
    assert answer(spark, []) == []
    assert answer(spark, [(4, [0.5, 0.5])]) == [(4, 0, 4, True)]
    assert answer(spark, [(4, None)]) == [(4, 0, 4, True)]


def test_ids_of_text(spark):
    schema = SCHEMA.replace("vec_id long", "vec_id string")
    rows = [("b", [1.0, 2.0]), ("a", [2.0, 4.0]), ("", [4.0, -2.0])]
    assert answer(spark, rows, schema) == brute(rows)


@pytest.mark.parametrize("rows", [100, 50_000, 10**9])
def test_calibration_finds_pairs_at_the_threshold(rows):
    rng = np.random.default_rng(8)
    # not centred: medians must do that
    sample = list(rng.normal(size=(400, 32)) + 1.5 * rng.normal(size=32))
    lists = fit_lists(sample, rows, 0.9, 0.95)
    assert lists.bits <= round(math.log2(rows / 4))
    assert rows > 10**6 or lists.bits == round(math.log2(rows / 4))
    x = rng.normal(size=(2000, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = rng.normal(size=x.shape)
    z -= (x * z).sum(1, keepdims=True) * x
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    lists = fit_lists(list(x[:500]), rows, 0.9, 0.95)
    found = lists.collisions(x, 0.9 * x + math.sqrt(0.19) * z).sum(1)
    assert (found >= lists.count).mean() > 0.92
    if rows > 1000:  # strangers hardly ever reach the count
        assert (lists.collisions(x, np.roll(x, 1, 0)).sum(1) >= lists.count).mean() < 0.01
