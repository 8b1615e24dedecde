"""Merkle manifests against a plain tree."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tideline.llm.merkle import leaf_digest, lower_ascii, manifest, siblings, verified_manifest

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, g int, pos string, digest int"
LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def H(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    said = (*row[:4], text)
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in said))


def tree(digests, fan):
    """Root, and per leaf the (left, right) siblings of each level."""
    paths, own = [[] for _ in digests], [[i] for i in range(len(digests))]
    while len(digests) > 1:
        up, owners = [], []
        for a in range(0, len(digests), fan):
            run = digests[a : a + fan]
            for k in range(len(run)):
                for i in own[a + k]:
                    paths[i].append(("".join(run[:k]), "".join(run[k + 1 :])))
            up.append(H("".join(run)))
            owners.append([i for o in own[a : a + fan] for i in o])
        digests, own = up, owners
    return digests[0], paths


def is_tampered(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0


def brute(rows, fan=8):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    trees = {}
    for lang, own in groups.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[4])))
        trees[lang] = tree([leaf(r, r[4]) for r in own], fan)
    langs = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    if not langs:
        return []
    root, above = tree([trees[x][0] for x in langs], fan)
    out = []
    for lang, over in zip(langs, above):
        for r, path in zip(groups[lang], trees[lang][1]):
            text = r[4].translate(LOW) if is_tampered(r[0]) and r[4] is not None else r[4]
            done = leaf(r, text)
            for left, right in path + over:
                done = H(left + done + right)
            proof = H("".join(a + b for a, b in path + over))
            out.append((r[0], leaf(r, r[4]), trees[lang][0], root, proof, done, done == root))
    return sorted(out, key=str)


def result(spark, rows, fan=8):
    docs = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA).repartition(3)
    out = verified_manifest(
        docs, F.crc32(F.col("doc_id").cast("string")) % 3 == 0, lower_ascii(F.col("text")), fan=fan
    )
    assert out.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in out.collect()), key=str)


ODD = [
    (1, "a", None, 3, "Abc"), (2, None, None, None, None), (3, "a", "", 0, ""), (4, "ü", "é", 1, "ÄB"),
    (5, "a", "z", 1, "x" * 300_000 + "Y"), (None, "a", "z", 1, "no id"), (None, "a", "z", 1, "no id"),
    (6, "a", "z", 1, "tie one"), (6, "a", "z", 1, "tie two"), (6, "a", "z", 1, "tie two"),
    (-7, "a", "-", 1, "-"), (8, "1:a", "Z", 1, "2:b"),
]


@pytest.mark.parametrize("fan", [8, 2])
def test_odd_rows(spark, fan):
    assert result(spark, ODD, fan) == brute(ODD, fan)


@pytest.mark.parametrize("n", [1, 8, 9, 64, 65, 700])
def test_sizes_of_runs_and_one_hot_group(spark, n):
    rows = [(i, f"s{i % 3}", "en", i, f"Text {i}") for i in range(n)]
    rows += [(n + i, "s", f"l{i:02d}", i, "T") for i in range(9 if n > 64 else 0)]
    got = result(spark, rows)
    assert got == brute(rows)
    assert {r[-1] for r in got if not is_tampered(r[0])} <= {True}
    assert {r[-1] for r in got if is_tampered(r[0])} <= {False}


def test_empty_table(spark):
    assert result(spark, []) == []


def test_any_change_of_any_row_changes_the_root(spark):
    rows = [(i, "s", "en" if i % 2 else "de", 1, f"t{i}") for i in range(20)]
    docs = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA)
    root = lambda df: {r.root for r in manifest(df).select("root").collect()}
    (first,) = root(docs)
    (second,) = root(docs.withColumn("text", F.when(F.col("doc_id") == 13, "u").otherwise(F.col("text"))))
    (moved,) = root(docs.withColumn("lang", F.when(F.col("doc_id") == 13, "de").otherwise(F.col("lang"))))
    assert len({first, second, moved}) == 3


def test_windows_never_cover_a_group(spark):
    nodes = spark.range(20).selectExpr("'' g", "id pos", "20L n", "string(id) digest")
    plan = siblings(nodes, 8)._jdf.queryExecution().toString()
    assert "div 4096" in plan
    level = {r.pos: (r.left, r.right) for r in siblings(nodes, 8).collect()}
    assert level[9] == ("8", "101112131415") and level[19] == ("161718", "") and level[16] == ("", "171819")


def test_leaf_fields_cannot_run_together(spark):
    pair = spark.createDataFrame([("a", "1:b"), ("a1:b", ""), ("-", None)], "x string, y string")
    assert len({r[0] for r in pair.select(leaf_digest(F.col("x"), F.col("y"))).collect()}) == 3
