"""Hard negatives against plain sums, and the tree's own promises."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tideline.llm.covertree import Best, CoverTree, hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label string, score long, v int, block int, dims string"


def brute(rows, by=5, positives=5, negatives=10, share=(30, 90)):
    taken = [
        (i, label, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v, label in rows
        if i is not None and label is not None and v is not None
        and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for a, own, q in taken:
        if a % by:
            continue
        rest = sorted((-sum(x * y for x, y in zip(q, v)), i, label == own)
                      for i, label, v in taken if i != a and len(v) == len(q))
        for s, p, _ in [r for r in rest if r[2]][:positives]:
            fit = [(i, t) for t, i, same in rest if not same and share[0] * -s <= 100 * -t <= share[1] * -s]
            out += [(a, p, rank, i, -s, -t) for rank, (i, t) in enumerate(fit[:negatives], 1)]
    return sorted(out)


def answer(spark, data, by=5, **how):
    df = spark.createDataFrame([(i, v, label, 1, 2, 3, "x") for i, v, label in data], SCHEMA)
    out = hard_negatives(df.repartition(3), F.col("label"), F.col("vec_id") % by == 0, **how)
    assert out.columns == [
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    ]
    return sorted(map(tuple, out.collect()))


def clustered(n, d, groups, rng, spread=0.1):
    centres = rng.normal(size=(groups, d))
    return centres[rng.integers(groups, size=n)] + spread * rng.normal(size=(n, d))


def test_levels_cover_and_separate():
    rng = np.random.default_rng(1)
    points = np.floor(256 * np.r_[clustered(150, 8, 6, rng), np.ones((5, 8)), np.zeros((3, 8))]).astype(np.int64)
    tree, order = CoverTree.grow(points)
    assert sorted(order) == list(range(len(points))) and (tree.points == points[order]).all()
    further = np.sqrt(np.maximum(tree.norm**2 - (tree.floats**2).sum(1), 0))
    whole = np.c_[tree.floats, further]
    away = np.sqrt(((whole[:, None] - whole[None]) ** 2).sum(2))

    def under(g):
        out = []
        while g >= 0:
            for p in range(tree.start[g], tree.stop[g]):
                out += [p, *under(tree.first[p])]
            g = tree.after[g]
        return out

    assert sorted(under(tree.first[0])) == list(range(1, len(points)))  # each point once
    owner = {tree.first[p]: p for p in range(len(points)) if tree.first[p] >= 0}
    for g, p in owner.items():
        while g >= 0:
            assert away[p, under(g)].max() <= tree.radius[g] + 1e-4
            g = tree.after[g]


@pytest.mark.parametrize("big", [False, True])
def test_search_is_exact_and_skips(big):
    rng = np.random.default_rng(2)
    points = np.floor((2**22 if big else 256) * clustered(1500, 16, 12, rng, 0.02)).astype(np.int64)
    if big:
        points[:, 0] = 2**26  # sums beyond what doubles hold exactly
    ids = rng.permutation(1500)
    tree, order = CoverTree.grow(points)
    share = []
    for at in range(0, 1500, 100):
        q, sums = points[at], (points * points[at]).sum(1)
        allowed = rng.random(1500) < 0.5
        top = int(np.sort(sums)[-5])
        windows = [Best(5), Best(10, int(0.3 * top), int(0.9 * top)), Best(3, 5, 4)]
        share.append(tree.search(q, allowed[order], ids[order], windows) / 1500)
        for w in windows:
            want = sorted((-int(s), int(i)) for s, i, ok in zip(sums, ids, allowed) if ok and w.low <= s <= w.high)
            assert list(zip((-w.scores).tolist(), w.ids.tolist())) == want[: w.k]
    assert np.mean(share) < 0.7  # whole branches were never scored


@pytest.mark.parametrize("how", [{}, {"rows": 20, "query_rows": 7, "trees": 2}])
def test_equals_brute_force(spark, how):
    rng = np.random.default_rng(3)
    x = np.round(clustered(160, 6, 5, rng), 1)
    rows = [(int(i), [float(a) for a in v], str(rng.integers(4))) for i, v in zip(rng.permutation(160), x)]
    rows += [(200 + i, [0.5] * 6, "0" if i % 3 else "1") for i in range(30)]  # ties
    rows += [(5, None, "1"), (None, [0.1] * 6, "1"), (10, [0.1] * 6, None), (15, [float("nan")] + [0.0] * 5, "1"),
             (20, [None] + [0.1] * 5, "1"), (25, [float("inf")] * 6, "2"), (1000, [], "1"), (1001, [], "1"),
             (1002, [], "2"), (300, [0.25, 1.0], "1"), (301, [0.5, 1.0], "1"), (302, [0.5, 0.25], "2"),
             (400, [0.0] * 6, "2"), (rows[0]), (rows[0])]
    assert answer(spark, rows, **how) == brute(rows)


def test_empty_and_alone(spark):
    assert answer(spark, []) == []
    assert answer(spark, [(5, [1.0], "a")]) == []
    assert answer(spark, [(5, [1.0], "a"), (6, [1.0], "a"), (7, [0.5], "b")]) == [(5, 6, 1, 7, 65536, 32768)]
    assert answer(spark, [(6, [1.0], "a"), (7, [0.5], "b")]) == []  # no anchor
