"""Document statistics against plain Python, trees on planted labels, whole texts."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tideline.llm.quality import (
    FEATURES, fit_forest, good_documents, quality_scores, statistics,
)

TEXTS = ["", "One two two. THREE!!\nfour | five\nfour | five", "a", "  \n ", "é É ß 1 2 2 2", "x " * 900]


def plain(text):
    data = text.encode()
    words = [w for w in __import__("re").split(rb"[ \x09-\x0d]+", data) if w]
    low = [w.lower() for w in words]
    n, size = max(len(words), 1), max(len(data), 1)
    lines = [tuple(x) for x in ([w.lower() for w in line.split()] for line in data.split(b"\n")) if x]
    pairs = list(zip(low, low[1:]))
    return {
        "log_bytes": np.log1p(len(data)), "log_words": np.log1p(len(words)),
        "bytes_per_word": len(data) / n,
        "longest_word": np.log1p(max(map(len, words), default=0)),
        "upper": sum(65 <= b <= 90 for b in data) / size, "bar": data.count(b"|") / size,
        "high_bytes": sum(b > 127 for b in data) / size,
        "lines_per_word": data.count(b"\n") / n, "distinct_words": len(set(low)) / n,
        "top_word": max((low.count(w) for w in set(low)), default=0) / n,
        "distinct_pairs": len(set(pairs)) / max(len(pairs), 1),
        "repeated_next": sum(a == b for a, b in pairs) / max(len(pairs), 1),
        "distinct_lines": len(set(lines)) / max(len(lines), 1),
        "odd_word_ends": sum(w[-1:] in b"#$%&*^~!|" for w in words) / n,
        "upper_words": sum(w[:1].isupper() and w[1:2].isupper() or len(w) == 1 and w.isupper()
                           for w in words) / n,
        "lower_starts": sum(w[:1].islower() for w in words) / n,
    }


def test_statistics_equal_plain_python():
    blobs = [t.encode() for t in TEXTS]
    x = statistics(np.frombuffer(b"".join(blobs), np.uint8), np.cumsum([0, *map(len, blobs)]))
    for row, text in zip(x, TEXTS):
        for name, value in plain(text).items():
            assert row[FEATURES.index(name)] == pytest.approx(value, rel=1e-5), (name, text[:20])


def walk(forest, row):
    total = forest.bias
    for at in forest.roots:
        while forest.left[at] != at:
            at = forest.right[at] if row[forest.feature[at]] > forest.threshold[at] else forest.left[at]
        total += forest.value[at]
    return 1 / (1 + np.exp(-total))


def test_flattened_forest_scores_like_a_walk_and_learns():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(4000, 5)).astype(np.float32)
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    forest = fit_forest(x[:3000], y[:3000], trees=30)
    score = forest.score(x[3000:], block=70)
    assert [walk(forest, r) for r in x[3000:3050]] == pytest.approx(list(score[:50]))
    assert ((score > 0.5) == y[3000:]).mean() > 0.97
    flat = fit_forest(x[:0], y[:0])
    assert list(flat.score(x[:2])) == [0.5, 0.5]


def test_held_out_rows_and_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    got = quality_scores(docs, labels)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = {r.doc_id: r for r in got.collect()}
    assert len(rows) == docs.count()
    for i, r in rows.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert r.predicted == int(r.score >= 0.7) and 0 <= r.score <= 1
    held = [(rows[r.doc_id].predicted, r.quality) for r in labels.collect() if rows[r.doc_id].held_out]
    assert len(held) > 50 and np.mean([a == b for a, b in held]) > 0.95
    # labels of held-out rows are not looked at
    hidden = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    turned = labels.withColumn("quality", F.when(hidden, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert {r.doc_id: r.score for r in quality_scores(docs, turned).collect()} == {
        i: r.score for i, r in rows.items()
    }
    good = good_documents(docs, labels)
    assert good.schema == docs.schema
    assert {r.doc_id for r in good.collect()} == {i for i, r in rows.items() if r.predicted}


def test_odd_rows(spark):
    schema = "doc_id long, text string, score string, id int"
    docs = spark.createDataFrame(
        [(None, None, "x", 1), (1, "", "x", 1), (2, "w " * 100_000, None, None), (2, "same", "x", 1),
         (2, "same", "x", 1)], schema)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    odd = spark.createDataFrame([(2, 1, 0), (2, 0, 0), (None, 1, 1), (1, None, 0), (7, 5, 0)], none.schema)
    for labels in (none, odd):
        rows = quality_scores(docs, labels).collect()
        assert len(rows) == 5 and all(0 <= r.score <= 1 for r in rows)
        assert quality_scores(docs.limit(0), labels).count() == 0
        assert good_documents(docs, labels, threshold=0.0).count() == 5
