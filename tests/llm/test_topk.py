"""Bit-sliced search against plain sums."""

import math

import numpy as np
import pytest

from tideline.llm.topk import best, divisible, scores, slices_of, top_k

SCHEMA = "vec_id long, embedding array<float>, label int, score string"


def brute(rows, k, by):
    vectors = [
        (i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for q, a in vectors:
        if q % by:
            continue
        found = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in vectors
                       if i != q and len(a) == len(b))
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(found[:k], 1)]
    return sorted(out)


def test_sums_and_selection():
    rng = np.random.default_rng(2)
    for n, d, span in ((1, 3, 5), (200, 7, 300), (130, 16, 4), (64, 1, 1), (90, 5, 100_000)):
        x = rng.integers(-span, span, (n, d))
        low, bits, slices = slices_of(x)
        q = rng.integers(-span, span + 1, d)
        total, constant = scores(slices, low, q)
        width = len(total)
        plain = [sum(((int(total[r, i >> 6]) >> (i & 63)) & 1) << r for r in range(width)) for i in range(n)]
        assert [p + constant for p in plain] == (x @ q).tolist()
        everyone = np.zeros(-(-n // 64) * 64, bool)
        everyone[:n] = rng.random(n) < 0.9
        rows, sums = best(total, np.packbits(everyone, bitorder="little").view(np.uint64), 5)
        want = sorted((-int(s), i) for i, s in enumerate(x @ q) if everyone[i])[:5]
        assert sorted((-s - constant, i) for i, s in zip(rows.tolist(), sums)) == want


@pytest.mark.parametrize("rows,query_rows", [(16_384, 512), (40, 3)])
def test_top_k_equals_brute_force(spark, rows, query_rows):
    rng = np.random.default_rng(4)
    data = [(int(i), [float(x) for x in np.round(rng.normal(size=6), 1)]) for i in rng.permutation(150)]
    data += [(200 + i, [0.5] * 6) for i in range(40)]  # ties
    data += [(5, None), (None, [0.1] * 6), (10, [float("nan")] + [0.0] * 5), (15, [None] + [0.1] * 5),
             (20, [float("inf")] * 6), (1000, []), (1001, []), (300, [0.25, 1.0]), (301, [-0.25, 1.0])]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in data], SCHEMA).repartition(3)
    got = top_k(df, divisible(df, by=5), rows=rows, query_rows=query_rows)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == brute(data, 5, 5)


def test_empty_and_few(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0], 1, "x"), (1, [1.0, -1.0], 1, "x")], SCHEMA)
    assert [tuple(r) for r in top_k(df, divisible(df)).collect()] == [(0, 1, 1, 256 * 256 - 512 * 256)]
    assert top_k(df.limit(0), df).count() == 0
    assert top_k(df, df.limit(0)).count() == 0
