"""Known texts inside longer ones, against plain Python that looks at every place."""

import os
import random
import textwrap

import pytest
import regex

from tideline.llm.licences import HEADERS, KNOWN, SPELLINGS, scan_licences

USUAL = dict(SPELLINGS)


def units(text):
    """Words of a text without copyright statements, each with what ends before it."""
    out, before = [], "\n"
    for m in regex.finditer(r"[\p{L}\p{N}]+|\n|[.!?:;](?=[ \t\r\n]|$)|[。！？]", (text or "").lower()):
        t = m[0]
        if t == "\n":
            before = "\n"
        elif t[0] in ".!?:;。！？":
            before = before or "."
        else:
            out.append([USUAL.get(t, t), before])
            before = ""
    return out


def brute(text, known):
    """(licences as lines, licences as passages) by comparing at every word."""
    words = units(text)
    ends = [b for _, b in words[1:]] + ["\n"]
    lines, passages = set(), set()
    for name, said in known:
        want = [w for w, _ in units(said)]
        for i in range(len(words) - len(want) + 1):
            j = i + len(want)
            if words[i][1] and ends[j - 1] and [w for w, _ in words[i:j]] == want:
                passages.add(name)
                inner = [b for _, b in words[i + 1 : j]]
                if words[i][1] == "\n" and ends[j - 1] == "\n" and "\n" not in inner:
                    lines.add(name)
    return ",".join(sorted(lines)), ",".join(sorted(passages))


def texts():
    rng = random.Random(3)
    words = "the licensed under permission this is free program of notice copying apache".split()
    filler = lambda: " ".join(rng.choice(words) for _ in range(rng.randrange(12)))
    out = [None, "", "\n\n", ".", "x " * 50_000, "licensed under " * 30_000, "-" * 100_000, "a\n" * 50_000]
    for name, text in KNOWN[5:] + HEADERS:
        body = " ".join(text.split())
        for width in (25, 60, 10_000):
            for mark in ("", "# ", " * ", "// "):
                wrapped = "\n".join(mark + x for x in textwrap.wrap(body, width))
                out += [wrapped, f"{filler()}\n{wrapped}\n{filler()}", f"{filler()}. {wrapped} {filler()}",
                        f"{filler()} {wrapped}", f"{wrapped.upper()}\r\n{filler()}"]
    return out


def test_known_texts_inside_others(spark):
    mine = [("Mine", "Dedicated to the public domain."), ("Mine", None), ("Other", ""), ("Yours", "x"),
            *KNOWN[5:], *HEADERS]
    given = texts() + ["Dedicated to the\npublic domain.", "a. Dedicated to the public domain! b", "not Dedicated to the public domain."]
    known = [k for k in mine if k[1]]
    df = spark.createDataFrame(list(enumerate(given)), "doc_id int, text string")
    for table in (mine, spark.createDataFrame(mine, "license string, text string")):
        got = {r.doc_id: (r.notices, r.passages) for r in scan_licences(df, table).collect()}
        wrong = [(i, given[i][:300], got[i], brute(given[i], known)) for i in got
                 if len(given[i] or "") < 20_000 and got[i] != brute(given[i], known)]
        assert wrong == [] and len(got) == len(given)
    assert got[len(given) - 3] == ("", "Mine") and got[len(given) - 2] == ("", "Mine") and got[len(given) - 1] == ("", "")


def test_passages_of_given_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = {r.doc_id: (r.notices, r.passages) for r in scan_licences(docs).collect()}
    said = [r for r in docs.collect() if not regex.search("copyright|\\(c\\)|©|rights reserved", (r.text or "").lower())]
    assert said and all(got[r.doc_id] == brute(r.text, KNOWN + HEADERS) for r in said)


def test_source_files_and_tags(spark):
    mit = KNOWN[0][1].partition("\n\n")[2]
    source = "/*\n * Copyright (c) 2020 Some One\n *\n" + "\n".join(
        " * " + x for x in textwrap.wrap(" ".join(mit.split()), 70)) + "\n */\nint main() { return 0; }\n"
    rows = [(1, source), (2, "// SPDX-License-Identifier: MIT\nint x;"), (None, None),
            (3, "# spdx-license-identifier: (GPL-2.0-only WITH Classpath-exception-2.0) or Apache-2.0 -->"),
            (4, "/* SPDX-License-Identifier: */"), (5, "Permission to\n" * 2000)]
    df = spark.createDataFrame([(*r, "l", "p", 1) for r in rows], "doc_id int, text string, license string, passages string, line int")
    got = {r.doc_id: (r.license, r.notices, r.passages, r.declared) for r in scan_licences(df).collect()}
    assert got == {1: (None, "", "MIT", ""), 2: (None, "", "", "MIT"), None: (None, "", "", ""),
                   3: (None, "", "", "Apache-2.0,GPL-2.0-only"), 4: (None, "", "", ""), 5: (None, "", "", "")}
    with pytest.raises(ValueError):
        scan_licences(df, max_known=3)


def test_long_known_texts_from_files(spark):
    folder = "/usr/share/common-licenses"
    names = ("Apache-2.0", "GPL-3", "LGPL-2.1", "MPL-2.0")
    if not all(os.path.exists(f"{folder}/{n}") for n in names):
        pytest.skip("no licence files on this machine")
    full = {n: open(f"{folder}/{n}").read() for n in names}
    known = spark.createDataFrame(list(full.items()), "license string, text string")
    # where a copyright statement ends shows in its line, so paragraphs that hold one keep their lines
    refill = lambda t, width: "\n\n".join(
        p if "Copyright (C)" in p else textwrap.fill(" ".join(p.split()), width) for p in t.split("\n\n"))
    rows = [(n, refill(t, 100_000), "before\n" + refill(t, 50) + "\nafter") for n, t in full.items()]
    df = spark.createDataFrame(rows, "doc_id string, text string, other string")
    assert {r.doc_id: r.license for r in scan_licences(df, known).collect()} == {n: n for n in names}
    assert {r.doc_id: r.passages for r in scan_licences(df, known, text_col="other").collect()} == {n: n for n in names}
