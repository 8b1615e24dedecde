"""Token pieces against the tokenizers library and the rules of packing."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tideline.llm.packing import boundaries, deal, pack, round_robin
from tideline.llm.tokens import ByteEncoder

BYTE = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(BYTE)
SCHEMA = "doc_id long, text string, source string, start int, block string, ids int"


def library(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def ids_of(data):
    return np.frombuffer(data, "<u4").tolist()


def test_byte_encoder_equals_library():
    texts = ["", " ", "  ", "a  b", " a b ", "a \n b", "a\n b  ", "it's  we'll\t x", "\xa0 x", "x \xa0",
             "a <|endoftext|> b", "x" * 5000 + " y", "é è 漢字   z", "\x1c a\x1d b", "\n\n", " \n",
             "a" + " " * 300 + "b", " 1 2  3", "tail "]
    encoder = ByteEncoder(BYTE)
    for _ in range(2):  # cold and warm
        assert [ids_of(x) for x in encoder.encode(texts)] == [library(t) for t in texts]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t'sa1.é\xa0\x1c "), st.characters(codec="utf-8"))))
def test_byte_encoder_on_any_text(text):
    assert ids_of(ENCODER.encode([text])[0]) == library(text)


ENCODER = ByteEncoder(BYTE)


def check_pieces(rows, texts, length):
    """Every token in one piece, sequences gapless and of a power of two."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(texts)
    for i, pieces in by_doc.items():
        ids = np.array(library(texts[i]) + [1], "<u4")
        at = 0
        for p in sorted(pieces, key=lambda p: p.start):
            assert p.start == at and p.length > 0 and p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == pieces[0].sequence_tokens <= length and at & (at - 1) == 0
    return by_sequence


def test_pack_given_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = pack(docs, BYTE, block_bytes=60_000, length=256, window=2).collect()
    sequences = check_pieces(rows, texts, 256)
    assert sum(len(s) for s in sequences.values()) == len(rows)


def test_pack_odd_rows(spark):
    data = [(1, None, "a", 1, "x", 2), (2, "", None, 1, "x", 2), (3, "word " * 30_000, "a", 1, "x", 2),
            (4, "one", None, None, None, None), (5, "one", "b", 1, "x", 2)]
    texts = {i: t for i, t, *_ in data}
    docs = spark.createDataFrame(data, SCHEMA)
    check_pieces(pack(docs, BYTE).collect(), texts, 2048)
    check_pieces(pack(docs, BYTE, source_col=None, target={"all": 1}).collect(), texts, 2048)
    assert pack(docs.limit(0), BYTE).count() == 0
    twice = docs.filter("doc_id = 5").union(docs.filter("doc_id = 5"))
    rows = pack(twice.withColumnRenamed("doc_id", "n"), BYTE, id_col="n", with_ids=True).collect()
    assert sum(r.length for r in rows) == 2 * (len(library("one")) + 1)
    assert [x for r in rows for x in r.ids] == (library("one") + [1]) * 2
    bare = spark.createDataFrame([(None, "a b", "s", 1, "x", 2)] * 2, SCHEMA)
    assert sum(r.length for r in pack(bare, BYTE).collect()) == 6


def test_boundaries():
    assert boundaries(0, 8) == []
    assert boundaries(8 * 2 + 7, 8) == [8, 16, 20, 22, 23]


@pytest.mark.parametrize("share", [{"a": 0.5, "b": 0.3, "c": 0.2}, {"a": 0.9, "b": 0.1}])
def test_windows_follow_the_mixture(share):
    """While no queue is empty every window's tokens stay within one document cut of its target."""
    queues = {s: [(k * 1000 + i, 5 + (i * 7) % 90) for i in range(400)] for k, s in enumerate("abc")}
    total = sum(n for q in queues.values() for _, n in q)
    window = 512
    pieces = list(round_robin(queues, share, {}, window, boundaries(total, 64)))
    assert sum(p[2] for p in pieces) == total
    got, at, left = {s: 0 for s in "abc"}, 0, {s: sum(n for _, n in q) for s, q in queues.items()}
    for d, _, n, _, _ in pieces:
        source = "abc"[d // 1000]
        got[source] += n
        at += n
        left[source] -= n
        if min(left[s] for s in share) < 2 * window:
            break
        if at % window == 0:
            for s in share:
                assert abs(got[s] - share[s] * at) <= 2


def test_deficits_come_from_earlier_blocks():
    """What a source was short of before is served first."""
    queues = {"a": [(0, 1000)], "b": [(1, 1000)]}
    pieces = list(round_robin(queues, {"a": 0.5, "b": 0.5}, {"a": -100.0, "b": 100.0}, 400, boundaries(2000, 64)))
    first = {0: 0, 1: 0}
    at = 0
    for d, _, n, _, _ in pieces:
        n = min(n, 400 - at)
        first[d] += n
        at += n
        if at == 400:
            break
    assert first == {0: 100, 1: 300}


def mixed(spark):
    """9,000 documents of 20 to 400 words, sources a, b and c at about 5, 3 and 2 tenths."""
    return spark.range(9000, numPartitions=4).selectExpr(
        "id AS doc_id", "repeat('word ', 20 + int(pmod(xxhash64(id, 1), 380))) AS text",
        "CASE WHEN pmod(xxhash64(id, 2), 10) < 5 THEN 'a' WHEN pmod(xxhash64(id, 2), 10) < 8 THEN 'b' ELSE 'c' END AS source",
    )


def full_windows(rows, window):
    """(block, tokens of earlier windows, tokens by source) of the whole windows of a packing."""
    found = {}
    for r in rows:
        block, sequence = r.sequence_id >> 32, r.sequence_id & 0xFFFFFFFF
        got = found.setdefault((block, sequence // 16), {})
        got[r.source] = got.get(r.source, 0) + r.length
    at, out = 0, []
    for (block, _), got in sorted(found.items()):
        if sum(got.values()) == window:
            out.append((block, at, got))
        at += sum(got.values())
    return out


def test_windows_of_late_blocks_follow_the_mixture(spark):
    rows = pack(mixed(spark), BYTE, block_bytes=100_000, length=128).collect()
    total = {s: sum(r.length for r in rows if r.source == s) for s in "abc"}
    everything = sum(total.values())
    windows = full_windows(rows, 16 * 128)
    late = [got for b, _, got in windows if b >= 40]
    assert len(late) > 200
    for got in late:
        for s in "abc":
            assert abs(got.get(s, 0) / 2048 - total[s] / everything) < 0.05
    # at the end of every block each source is about one document off
    at, own = 0, dict.fromkeys("abc", 0)
    for block in range(max(r.sequence_id >> 32 for r in rows)):
        for r in rows:
            if r.sequence_id >> 32 == block:
                at, own[r.source] = at + r.length, own[r.source] + r.length
        assert all(abs(own[s] - total[s] / everything * at) < 1000 for s in "abc")


def test_windows_of_late_blocks_follow_a_target(spark):
    """a runs dry last of the two named; c, not named, comes when both have."""
    rows = pack(mixed(spark), BYTE, block_bytes=100_000, length=128, target={"a": 2, "b": 2}).collect()
    assert len({r.doc_id for r in rows}) == 9000
    total = {s: sum(r.length for r in rows if r.source == s) for s in "abc"}
    phases = {"both": 0, "a": 0, "c": 0}
    for _, at, got in full_windows(rows, 16 * 128):
        if at < 2 * total["b"] - 20_000:
            assert abs(got.get("a", 0) / 2048 - 0.5) < 0.05 and "c" not in got
            phases["both"] += 1
        elif 2 * total["b"] + 20_000 < at < total["a"] + total["b"] - 40_000:
            assert got == {"a": 2048}
            phases["a"] += 1
        elif at > total["a"] + total["b"] + 20_000:
            assert got == {"c": 2048}
            phases["c"] += 1
    assert min(phases.values()) > 50


def test_sources_of_one_document_spread_over_blocks(spark):
    docs = spark.range(2000, numPartitions=4).selectExpr(
        "id AS doc_id", "repeat('word ', 100) AS text", "string(id) AS source"
    )
    held = {}
    for r in pack(docs, BYTE, block_bytes=50_000).collect():
        held[r.sequence_id >> 32] = held.get(r.sequence_id >> 32, 0) + r.length
    assert len(held) == 20 and max(held.values()) < 2 * min(held.values())


def block_shares(rows, source):
    """Share of a source in each block, blocks being whole."""
    held = {}
    for r in rows:
        got = held.setdefault(r.sequence_id >> 32, [0, 0])
        got[0] += r.length
        got[1] += r.length if r.source == source else 0
    return [own / n for _, (n, own) in sorted(held.items())]


def test_one_text_of_half_the_corpus(spark):
    """It crosses blocks; all windows keep the mixture."""
    docs = spark.range(400, numPartitions=4).selectExpr(
        "id AS doc_id", "repeat('word ', 300) AS text", "'short' AS source"
    ).union(spark.range(1).selectExpr("1000 + id", "repeat('word ', 120000)", "'long'"))
    rows = pack(docs, BYTE, block_bytes=100_000, length=128).collect()
    total = {s: sum(r.length for r in rows if r.source == s) for s in ("short", "long")}
    share = total["long"] / sum(total.values())
    windows = full_windows(rows, 16 * 128)
    assert len(windows) > 80
    for _, _, got in windows:
        assert abs(got.get("long", 0) / 2048 - share) < 0.05
    texts = {r.doc_id: r.text for r in docs.collect()}
    check_pieces(rows, texts, 128)


def test_equal_and_empty_rows_spread_over_blocks(spark):
    docs = spark.range(6000, numPartitions=4).selectExpr(
        "IF(id % 2 = 0, 7, NULL) AS doc_id", "IF(id % 2 = 0, repeat('word ', 40), '') AS text",
        "IF(id % 2 = 0, 'same', 'empty') AS source",
    )
    rows = pack(docs, BYTE, block_bytes=16_000, length=128).collect()
    assert sum(r.length for r in rows) == 3000 * (len(library("word " * 40)) + 1) + 3000
    whole = sum(r.length for r in rows if r.source == "empty") / sum(r.length for r in rows)
    shares = block_shares(rows, "empty")
    assert len(shares) > 30 and max(abs(x - whole) for x in shares) < 0.02
    only = spark.range(5000, numPartitions=2).selectExpr("id AS doc_id", "CAST(NULL AS STRING) AS text", "'s' AS source")
    held = {r.sequence_id >> 32 for r in pack(only, BYTE, block_bytes=16_000).collect()}
    assert len(held) == 20


def test_ids_of_text_and_other_texts_of_an_id(spark):
    data = [("", "a b", "s"), ("x", "c", "s"), ("x", "d e f", "s"), (None, "g", "s"), ("", None, "t")]
    docs = spark.createDataFrame(data, "doc_id string, text string, source string")
    rows = pack(docs, BYTE, with_ids=True).collect()
    got = {}
    for r in sorted(rows, key=lambda r: r.start):
        got.setdefault((r.doc_id, r.doc_tokens), []).extend(r.ids)
    want = {(i, len(library(t)) + 1): library(t) + [1] for i, t, _ in data}
    assert got == want


def test_blocks_begin_with_the_deficits_of_earlier_ones(spark):
    """Served and owed tokens of a source add up to its target at the start of every block."""
    counts = spark.range(3000, numPartitions=3).selectExpr(
        "id AS row", "IF(id % 3 = 0, 'a', 'b') AS source", "xxhash64(id) AS h", "1 + id % 50 AS tokens"
    )
    total = counts.groupBy("source").sum("tokens").collect()
    whole = {r[0]: r[1] for r in total}
    n = sum(whole.values())
    dealt = deal(counts, 3000, n / 20, n, {}).join(counts, "row").collect()
    served = {s: 0 for s in whole}
    for block in range(20):
        here = [r for r in dealt if r.block == block]
        for s in whole:
            carries = {r.carry for r in here if r.source == s}
            assert len(carries) == 1 and abs(carries.pop() - (whole[s] * block / 20 - served[s])) < 1e-6
            assert abs(whole[s] * block / 20 - served[s]) <= 50
        for r in here:
            assert abs(r.share - whole[r.source] / n) < 1e-9
            served[r.source] += r.tokens
