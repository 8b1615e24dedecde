"""Urls, archives, licences and chat against plain Python."""

import base64
import gzip
import hashlib

import pytest

from tideline.llm import warc
from tideline.llm.chat import flat, format_preferences, mask
from tideline.llm.licences import KNOWN, scan_licences
from tideline.llm.queries import QUERIES, URL_RULES
from tideline.llm.urls import judge_urls, labelled_urls
from tideline.llm.warc import (
    assemble, page_records, parse_records, read_archives, write_archives,
)
from tideline.session import scratch_path


def split_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3 :]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, tail = rest[:cut], rest[cut:]
    end = min([tail.find(c) for c in "?#" if c in tail], default=len(tail))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), tail[:end]


def rule_for(host, path):
    found = [(len(h + p), h + p, v) for h, p, v in URL_RULES
             if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(found)[1:] if found else (None, None)


ODD = [None, "", "x", "://", "http://", "HTTP://WWW.Example.COM/en/a?b#c", "a://B.example.com/en",
       "a://example.com/en/x", "a://xexample.com/en/", "a://net/es/1", "a://a.net/es", "a://É.NET/fr/",
       "a://h?x=/es/", "a://h.net#/fr/", "b://c://d/e", "a://x.org/\nq", "a://com", "a://com/",
       "http://" + "y" * 60_000 + ".org/z"]


def test_urls_rules_and_verdicts(spark, sf):
    urls = list(enumerate(ODD)) + [(1, "a://b/"), (None, "a://b/")]
    df = spark.createDataFrame([(i, u, "x", "y") for i, u in urls], "page_id long, url string, host string, path int"
                               .replace("path int", "path string"))
    got = judge_urls(df, URL_RULES).collect()
    assert len(got) == len(urls)
    want = sorted(((i, *split_url(u), rule_for(*split_url(u))[0]) for i, u in urls), key=str)
    assert sorted(((r.page_id, r.host, r.path, r.rule) for r in got), key=str) == want
    for r in got:
        told = rule_for(r.host, r.path)[1]
        assert r.verdict == (told or ("block" if r.score >= 0.5 else "allow"))
    assert judge_urls(df.limit(0), URL_RULES).count() == 0


def test_url_model_on_unseen_sites(spark):
    bad = ["casino-win", "free-bets", "ads-track", "spam-farm", "cheap-pills", "adult-x"]
    good = ["thther", "tionsh", "therwh", "ththly", "tionble", "city-library", "thonth", "theres"]
    rows = [(i, f"https://m.{h}.example.org/de/{i}{end}", i < len(bad))
            for i, h in enumerate(bad + good) for end in ("", "/", ".html", "?page=2&ref=x")]
    df = spark.createDataFrame(rows, "page_id long, url string, bad boolean")
    seen = {r.url for r in labelled_urls(spark).collect()}
    assert not seen & {r[1] for r in rows}
    hits = [(r.verdict == "block") == (r.page_id < len(bad)) for r in judge_urls(df).collect()]
    assert sum(hits) >= 0.95 * len(hits)


def plain_pages(rows, least=0):
    """A row per row: of equal bodies one row with the largest id is the response."""
    groups = {}
    for i, _, html in rows:
        groups.setdefault((html or "").encode(), []).append(i)
    out = []
    for body, ids in groups.items():
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        ids = sorted(ids, key=lambda i: (i is not None, i or 0))
        for at, i in enumerate(ids):
            first = len(body) < least or at == len(ids) - 1
            out.append((i, len(body), digest, "response" if first else "revisit", None if first else ids[-1]))
    return sorted(out, key=str)


PAGES = [(1, "http://a/b", "same"), (5, "http://c/d?e#f", "same"), (3, None, "same"), (7, "u\r\nWARC-Type: x", ""),
         (8, "http://é/ü", None), (9, "x", "WARC/1.0\r\n\r\n\r\n\r\nWARC/1.0\r\nContent-Length: 5\r\n\r\nabc"),
         (10, "http://h/", "é" * 70_000), (11, "http://h/", "\n"), (11, "http://h/", "\n"), (12, "q", "\r\n\r\n")]


@pytest.mark.parametrize("least", [0, 3])
def test_archives_round_trip(spark, least):
    df = spark.createDataFrame([(i, u, h, "x", 1) for i, u, h in PAGES],
                               "page_id long, url string, html string, value string, size int").repartition(2)
    folder = write_archives(df, scratch_path(spark, "warc-test"), min_bytes=least)
    told = assemble(read_archives(spark, folder))
    got = page_records(told).collect()
    assert sorted(map(tuple, got), key=str) == plain_pages(PAGES, least)
    by_page = {}
    for r in told.collect():
        assert r.request and r.metadata and r.response.record_id == r.record_id
        page = int(r.metadata.fields.split("\r\n")[0].removeprefix("page-id: "))
        by_page[page] = r
    for i, url, html in PAGES:
        r = by_page[i]
        if r.response.type == "response":
            assert bytes(r.response.payload).decode() == (html or "")
            assert r.response.declared_digest == r.response.payload_digest
        assert r.response.target_uri == (url and url.replace("\r", "%0D").replace("\n", "%0A"))
    assert page_records(assemble(read_archives(
        spark, write_archives(df.limit(0), scratch_path(spark, "warc-none"))))).count() == 0


def test_parser_reads_members_and_refuses_cuts():
    one = b"WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 9\r\n\r\nH\r\n\r\nbody\r\n\r\n"
    plain = list(parse_records(one * 2, True))
    assert [r["payload"] for r in plain] == [b"body"] * 2
    assert list(parse_records(gzip.compress(one) + gzip.compress(one), True)) == plain
    with pytest.raises(ValueError):
        list(parse_records(one[:-9], True))


def test_warc_query(spark, sf):
    pages = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    assert sorted(map(tuple, QUERIES["op8_warc"](spark, sf).collect()), key=str) == plain_pages(pages)


REPEATED = [(1, "http://a/", "x"), (1, "http://a/", "x"), (1, "http://a/", "x"), (2, "http://a/", "x"),
            (2, "http://a/", "x"), (None, "u", "y"), (None, "u", "y"), (None, "v", "x"), (None, None, None),
            (None, None, None), (4, "w", "alone")]


@pytest.mark.parametrize("least", [0, 2])
def test_every_row_is_a_capture(spark, least):
    df = spark.createDataFrame(REPEATED, "page_id long, url string, html string").repartition(3)
    folder = write_archives(df, scratch_path(spark, "warc-same"), min_bytes=least)
    told = assemble(read_archives(spark, folder))
    got = page_records(told).collect()
    assert len(got) == len(REPEATED)
    assert sorted(map(tuple, got), key=str) == plain_pages(REPEATED, least)
    # revisits name a record that is there, a response with their digest
    by_id = {r.record_id: r.response for r in told.collect()}
    assert len(by_id) == len(REPEATED)
    for r in by_id.values():
        if r.type == "revisit":
            assert by_id[r.refers_to].payload_digest == r.declared_digest


def test_large_captures_that_lie_together(spark, monkeypatch):
    """Files are cut by the largest capture, not by the average one alone."""
    monkeypatch.setattr(warc, "FILE_BYTES", 2_000_000)
    monkeypatch.setattr(warc, "MOST_BYTES", 1_000_000)
    rows = [(i, "u", "s") for i in range(400)] + [(1000 + i, "u", f"{i:06d}" * 40_000) for i in range(10)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    folder = write_archives(df, scratch_path(spark, "warc-large"))
    files = spark.read.format("binaryFile").load(folder).select("content").collect()
    assert max(len(gzip.decompress(bytes(f.content))) for f in files) < 1_000_000
    assert page_records(assemble(read_archives(spark, folder))).count() == len(rows)


def test_licences(spark):
    mit = dict(KNOWN[:1])["MIT"]
    altered = "  /* Copyright (c) 2020 Some One */\n" + mit.upper().replace("SOFTWARE", "software").replace(
        ",", " ;").replace("\n\n", "\n \n")
    rows = [(1, mit), (2, altered), (3, mit + " and more"), (4, None), (5, ""), (6, "hello\nReleased under the MIT Licence.\nbye"),
            (7, "© 2001\nLicensed  under the Apache Licence, version 2.0"), (7, "same"), (None, mit), (8, "x " * 100_000),
            (9, KNOWN[1][1].replace("ISC License", "ISC licence\nAll Rights Reserved."))]
    df = spark.createDataFrame([(i, t, "no", "z") for i, t in rows], "doc_id long, text string, license string, notices string")
    got = sorted(((r.doc_id or 0, r.license, r.notices) for r in scan_licences(df).collect()), key=str)
    assert got == sorted([(1, "MIT", ""), (2, "MIT", ""), (3, None, ""), (4, None, ""), (5, None, ""), (6, None, "MIT"),
                          (7, "Apache-2.0", "Apache-2.0"), (7, None, ""), (0, "MIT", ""), (8, None, ""), (9, "ISC", "")], key=str)
    assert scan_licences(df.limit(0)).count() == 0
    assert {r.license for r in scan_licences(df, known=[]).collect()} == {None}


def test_licences_in_any_wrapping(spark):
    import textwrap
    full = {}
    for name, text in KNOWN:
        if len(text) > 200:
            title, _, body = text.partition("\n\n") if name != "0BSD" else ("", "", text)
            full[name] = title, body
    mine = ["Copyright (c) 2020 Some One", "Copyright 2019-2021 John Q. Public and others. All rights reserved.",
            "Copyright Foo Inc.", "(c) 2020 X", "Copyright (c) <year> <owner>. All rights reserved."]
    rows = []
    for name, (title, body) in full.items():
        for width in (30, 50, 60, 64, 68, 72, 76, 78, 80, 90, 100, 120):
            rows.append((name, "\n\n".join([title, mine[0], textwrap.fill(body, width)])))
        for statement in mine:
            rows.append((name, f"{statement}\n\n{body}"))
        for statement in (mine[0], mine[1], mine[4], "Copyright (c) 2020 X, Inc."):
            rows.append((name, " ".join(f"{title} {statement} {body}".split())))
        rows.append((name, f"The {title} ({name})\n{body}") if name in ("MIT", "ISC") else (name, body))
        rows.append((name, body))
    isc = full["ISC"][1]
    rows.append(("ISC", "Copyright (c) 2020 X\n" + isc.replace("above copyright", "above\ncopyright")))
    notice = "Copyright (c) 2020 X. Licensed under the Apache License, Version 2.0."
    rows += [("Apache-2.0", notice), ("Apache-2.0", notice.replace("X", "X, Inc"))]
    other = [("", "(c) you must keep this.\nend"), ("", "(c) you may drop this.\nend"), ("", "end"),
             ("", "copyright law of 1976 is old.\nend"), ("", "copyright notices stay.\nend"),
             ("", "It was copyright (c) 2020 by me, I like cats."), ("", "It was copyright (c) 2020 by me, I like dogs.")]
    df = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows + other)], "doc_id int, text string")
    got = {r.doc_id: r for r in scan_licences(df).collect()}
    assert [(n, t) for i, (n, t) in enumerate(rows) if got[i].license != n] == []
    rest = [got[len(rows) + i] for i in range(len(other))]
    assert all(r.license is None for r in rest) and len({r.canonical_sha256 for r in rest}) == len(other)
    assert got[len(rows) - 1].notices == "Apache-2.0"


def test_licence_notices_in_given_documents(spark, sf):
    import re
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    notices = {t: n for n, t in KNOWN if len(t) < 100}
    want = {i: ",".join(sorted({notices[x] for x in t.split("\n") if x in notices})) for i, t in texts.items()}
    got = {r.doc_id: r.notices for r in QUERIES["op2_license_scan"](spark, sf).collect()}
    assert got == want and any(want.values()) and re


def test_chat(spark):
    schema = "pair_id long, turn long, role string, text string, said string, first int"
    one = [(1, 0, "user", "hi"), (1, 1, "assistant", "a <|end|>"), (1, 2, "user", None), (2, 0, "user", "x"), (3, 0, None, "q"),
           (4, 0, "user", "s"), (4, 1, "assistant", "t"), (None, 0, "user", "lost"), (4, None, "user", "lost"), (1, 0, "user", "hi")]
    two = [(1, 0, "user", "hi"), (1, 1, "assistant", "b"), (1, 2, "user", ""), (5, 0, "assistant", "only"), (3, 0, None, "q"),
           (4, 0, "user", "s"), (4, 1, "assistant", "t"), (4, 2, "user", "more")]
    make = lambda rows: spark.createDataFrame([(*r, "x", 1) for r in rows], schema)
    told = format_preferences(make(one), make(two))
    rows = {r[0]: tuple(r[1:]) for r in told.select(
        "pair_id", "prompt", "prompt_turns", flat("chosen"), flat("rejected"), mask("chosen"), mask("rejected")).collect()}
    u, a = "<|user|>\n", "<|assistant|>\n"
    assert rows == {
        1: (f"{u}hi<|end|>\n", 1, f"{a}a < |end|><|end|>\n{u}<|end|>\n", f"{a}b<|end|>\n{u}<|end|>\n",
            "0:14,1:18,0:9,0:8", "0:14,1:9,0:9,0:8"),
        2: ("", 0, f"{u}x<|end|>\n", "", "0:9,0:9", ""),
        3: ("<|unknown|>\nq<|end|>\n", 1, "", "", "", ""),
        4: (f"{u}s<|end|>\n{a}t<|end|>\n", 2, "", f"{u}more<|end|>\n", "", "0:9,0:12"),
        5: ("", 0, "", f"{a}only<|end|>\n", "", "0:14,1:12"),
    }
    assert format_preferences(make(one).limit(0), make(two).limit(0)).count() == 0
