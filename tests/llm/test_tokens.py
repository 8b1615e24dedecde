"""Backtracking BPE against the tokenizers library."""

import hashlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tideline.llm.bpe import WordBpe, encode_texts, round_trip

WORD = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(WORD)
LIBRARY.no_truncation()
LIBRARY.no_padding()
OURS = WordBpe(WORD)


def library(text):
    ids = LIBRARY.encode(text or "", add_special_tokens=False).ids
    return ids, LIBRARY.decode(ids, skip_special_tokens=False)


def ours(texts):
    encoded = OURS.encode(texts)
    return [(np.frombuffer(e, "<u4").tolist(), d.decode()) for e, d in zip(encoded, OURS.decode(encoded))]


def test_odd_texts():
    texts = ["", " ", "a", "it's we'll I'd 'S", "<|startoftext|> x<|endoftext|>y", "ΑΣ ΑΣΑ Σ", "İI",
             "é ́x", "12 3.4!!", "x" * 30_000, "aaaa" * 5000 + "b", "\x1cA\x1d", "a\x85b",
             "漢字 かな 한국", "🙂🙂 ok", "don't 'tis", "가", "ſt ǅ", "<|endoftext|" , "</w> x</w>"]
    for _ in range(2):
        for text, got in zip(texts, ours(texts)):
            assert got == library(text), text[:30]


def test_every_letter_of_the_basic_plane():
    marks = [chr(c) for c in range(1, 0x3100) if not 0xD800 <= c < 0xE000]
    texts = [f"a{m}b {m} Q{m}" for m in marks]
    for text, got in zip(texts, ours(texts)):
        assert got == library(text), [hex(ord(c)) for c in text]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n'stTHE.12é<|>"), st.characters(codec="utf-8"))))
def test_any_text(text):
    assert ours([text])[0] == library(text)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aeinorstthl", min_size=1, max_size=200))
def test_long_words(text):
    assert ours([text])[0] == library(text)


def test_round_trip_of_given_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = round_trip(docs, WORD).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids, text = library(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_odd_rows(spark):
    docs = spark.createDataFrame(
        [(None, None, "x", 1), (1, "", None, 2), (2, "two", "y", None), (2, "two", "y", None)],
        "doc_id long, text string, ids string, n_tokens int")
    got = sorted(((r.doc_id or 0, list(r.ids)) for r in encode_texts(docs, WORD).collect()))
    two = library("two")[0]
    assert got == [(0, []), (1, []), (2, two), (2, two)]
    assert round_trip(docs.limit(0), WORD).count() == 0
