"""Exact and near copies against brute force."""

import hashlib
import random
import re
import string

import pytest
from pyspark.sql import functions as F

from tideline.llm.components import components
from tideline.llm.exact_dedup import digest_entries, drop_copies, exact_dedup, tree_merge
from tideline.llm.near_dedup import drop_near_copies, fewest_matches, near_dedup

LOW = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
SCHEMA = "doc_id long, text string, lang string, id long, kept string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "xx", 5, "no") for i, t in rows], SCHEMA).repartition(3)


def brute_exact(rows, pick):
    groups = {}
    for i, t in rows:
        groups.setdefault((t or "").translate(LOW), []).append(i)
    out = []
    for t, ids in groups.items():
        named = [i for i in ids if i is not None]
        keep = pick(named) if named else None
        sha = hashlib.sha256(t.encode()).hexdigest()
        out += [(i, keep, len(ids), i == keep, sha) for i in ids]
    return sorted(out, key=str)


EXACT = [(1, "Ab c"), (2, "aB C"), (3, "ab  c"), (4, None), (5, ""), (6, "É"), (7, "é"), (9, "É x"),
         (8, "x" * 50_000), (11, "X" * 50_000), (12, "ab c"), (None, "AB C"), (None, "lone"),
         (None, "LONE"), (13, "twice"), (13, "twice")]


@pytest.mark.parametrize("keep,pick", [("largest", max), ("smallest", min)])
def test_exact_groups(spark, keep, pick):
    for rows in (EXACT, [], [(1, None)]):
        got = exact_dedup(frame(spark, rows), keep=keep, levels=4, bits=2).collect()
        assert sorted(map(tuple, got), key=str) == brute_exact(rows, pick)


def test_drop_copies_keeps_one_row_of_each_text(spark):
    got = drop_copies(frame(spark, EXACT), keep="largest")
    assert got.columns == ["doc_id", "text", "lang", "id", "kept"]
    rows = [(r.doc_id, (r.text or "").translate(LOW)) for r in got.collect()]
    texts = {(t or "").translate(LOW) for _, t in EXACT}
    assert sorted(t for _, t in rows) == sorted(texts)
    assert drop_copies(frame(spark, [])).count() == 0


def shingles(text, k):
    words = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOW))
    if len(words) < k:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def brute_near(rows, k, percent=80):
    sets = [(i, shingles(t, k)) for i, t in rows]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            common = len(a & b)
            if a and b and 100 * common >= percent * (len(a) + len(b) - common):
                low, high = sorted((find(i), find(j)))
                root[high] = low
    return sorted((i, len(s), find(i), find(i) == i) for i, s in sets)


def corpus(seed, families=12, size=14, passage=30):
    """Families of edited copies, unlike texts with one passage, short and odd texts."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(2, 6)))
    shared = [word() for _ in range(60)]
    texts = []
    for _ in range(families):
        base = [word() for _ in range(rng.randint(20, 120))]
        for _ in range(size):
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = word()
            texts.append(" ".join(copy))
    texts += [" ".join(shared + [word() for _ in range(40)]) for _ in range(passage)]
    texts += ["one two three", "One  two\tthree", "one two", "", None, " \n ", "é à", "a b c d e",
              "a b c d e " * 900]
    rng.shuffle(texts)
    ids = rng.sample(range(10_000), len(texts))
    return list(zip(ids, texts))


@pytest.mark.parametrize("k,few,cell", [(4, 64, 2048), (5, 3, 8)])
def test_near_components(spark, k, few, cell):
    rows = corpus(k)
    got = near_dedup(frame(spark, rows), shingle=k, few=few, cell=cell).collect()
    assert sorted(map(tuple, got)) == brute_near(rows, k)


def test_chain_far_from_its_hub(spark):
    rng = random.Random(3)
    text = [str(rng.random()) for _ in range(60)]
    rows = []
    for i in range(40):  # each step changes two words more, so that the ends are unlike
        rows.append((100 - i, " ".join(text)))
        text[(i * 7) % 60] = f"new{i}"
    got = near_dedup(frame(spark, rows), shingle=4, few=2, cell=16).collect()
    assert sorted(map(tuple, got)) == brute_near(rows, 4)


def test_cells_beyond_the_short_path(spark):
    """A family of near misses in one bucket of more than 64, whole and in parts."""
    rng = random.Random(5)
    base = [str(rng.random()) for _ in range(80)]
    rows = []
    for i in range(150):
        copy = list(base)
        for _ in range(rng.choice([1, 2, 3, 4])):
            copy[rng.randrange(len(copy))] = f"w{rng.random()}"
        rows.append((i, " ".join(copy)))
    want = brute_near(rows, 4)
    assert len({c for _, _, c, _ in want}) > 5
    for cell in (2048, 100):
        got = near_dedup(frame(spark, rows), shingle=4, cell=cell).collect()
        assert sorted(map(tuple, got)) == want


def test_near_odd_rows(spark):
    assert near_dedup(frame(spark, [])).count() == 0
    rows = [(None, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (4, None), (None, None)]
    got = sorted(map(tuple, near_dedup(frame(spark, rows)).collect()), key=str)
    assert got == sorted([(None, 2, None, True), (3, 2, 3, True), (3, 2, 3, True),
                          (4, 0, 4, True), (None, 0, None, True)], key=str)
    rows = corpus(9, 3)
    kept = {r.doc_id for r in drop_near_copies(frame(spark, rows), shingle=5).collect()}
    assert kept == {i for i, _, _, k in brute_near(rows, 5) if k}


def test_near_copies_take_no_other_text_of_their_id(spark):
    rng = random.Random(11)
    text = [str(rng.random()) for _ in range(60)]
    near, other = " ".join(["changed", *text[1:]]), " ".join(str(rng.random()) for _ in range(50))
    rows = [(1, " ".join(text)), (2, near), (2, other), (2, None), (None, near), (3, other), (4, near), (4, near)]
    for data in (rows, rows[::-1]):
        got = [(r.doc_id, r.text) for r in drop_near_copies(frame(spark, data)).collect()]
        assert sorted(got, key=str) == sorted([rows[0], rows[2], rows[3], rows[4]], key=str)
    assert drop_near_copies(frame(spark, [])).count() == 0
    got = drop_near_copies(frame(spark, rows))
    assert got.columns == ["doc_id", "text", "lang", "id", "kept"] and {r.lang for r in got.collect()} == {"xx"}


@pytest.mark.parametrize("few,cell", [(64, 2048), (3, 8)])
def test_near_components_of_text_ids(spark, few, cell):
    rows = [(f"{i:05d}é" if i % 2 else f"{i:05d}", t) for i, t in corpus(4, 6)]
    df = spark.createDataFrame([(i, t, "xx", 5, "no") for i, t in rows], SCHEMA.replace("doc_id long", "doc_id string"))
    got = near_dedup(df.repartition(3), shingle=4, few=few, cell=cell).collect()
    assert sorted(map(tuple, got)) == brute_near(rows, 4)


def test_posterior_bound():
    """A pair at the threshold is dropped in any batch with at most the miss chance."""
    needed = fewest_matches(200, 40, 0.8, 1e-5)
    assert needed == sorted(needed) and len(needed) == 5
    assert 0.55 * 200 < needed[-1] < 0.8 * 200


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(0, 60)]
    star = [(200, i) for i in range(100, 140)]
    pairs = spark.createDataFrame(path + star + [(7, 7)], "a long, b long")
    got = {r.node: r.component for r in components(pairs).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in [*range(100, 140), 200]}}
    assert components(pairs.filter(F.lit(False))).count() == 0


def test_runs_are_partitions_that_meet_in_binomial_rounds(spark):
    from pyspark.sql import functions as F

    from tideline.session import stable
    rows = [(i if i % 5 else None, "hot" if i % 3 == 0 else f"text {i % 700}") for i in range(5000)]
    entries = stable(digest_entries(spark.createDataFrame(rows, "doc_id int, text string").repartition(7)))
    for levels in (1, 3, 4):
        runs = tree_merge(entries, levels)
        plan = runs._jdf.queryExecution().executedPlan().toString()
        # a shuffle and a sort per round, after each task has merged its own rows
        assert plan.count("Exchange shufflepartitionidpassthrough") == levels
        assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Exchange ") == levels + 1
        assert plan.count("Sort [") == levels + 2 and "HashAggregate" not in plan
        placed = runs.select("digest", F.spark_partition_id().alias("run"), "keep_id", "group_size").collect()
        assert all(r.digest & (2 ** levels - 1) == r.run for r in placed)
        assert len({r.digest for r in placed}) == len(placed) == len({t for _, t in rows})
        assert sum(r.group_size for r in placed) == len(rows)
        hot = max(placed, key=lambda r: r.group_size)
        assert (hot.keep_id, hot.group_size) == (3, len([1 for _, t in rows if t == "hot"]))
