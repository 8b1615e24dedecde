"""BPE encoding by backtracking over longest matches, decoding by an offset table.

A word's encoding is the one sequence of tokens that cover it and of which each
neighbouring pair is compatible, that is, merges of the pair's own text give
just that pair.  The encoder takes the longest token at its place
(Aho-Corasick), checks it against the token before, tries its longest proper
prefixes, and steps back where none fits, marking the place as dead, so every
place is left once and the time is linear in the word.  Compatible pairs are
kept in a table that fills as pairs occur.

Words and white-space-free pieces of text recur, so their ids are kept per
worker up to a bound.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.textbytes import chunks

KEPT, LONG = 300_000, 64
_FILE_SEPARATORS = "\x1c\x1d\x1e\x1f"  # white space to str.split, not to the pattern


class Merges:
    """Tokens numbered by the order in which merges make them, and the pair table."""

    END = "\x01"  # marks a word's end inside token texts; no byte's letter

    def __init__(self, vocab: dict[str, int], merges: list, suffix: str):
        import ahocorasick

        mark = lambda t: t[: -len(suffix)] + self.END if suffix and t.endswith(suffix) else t
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        made = [mark(a + b) if not (suffix and a.endswith(suffix)) else None for a, b in pairs]
        known = set(made)
        base = [mark(t) for t in vocab if mark(t) not in known]
        self.texts = base + made
        if None in known or len(set(self.texts)) != len(self.texts):
            raise ValueError("every token must come from one merge")
        number = {t: i for i, t in enumerate(self.texts)}
        self.ids = [0] * len(self.texts)
        for t, i in vocab.items():
            self.ids[number[mark(t)]] = i
        self.left = list(range(len(self.texts)))
        self.right = list(range(len(self.texts)))
        self.merged: dict[tuple[int, int], int] = {}
        for i, (a, b) in enumerate(pairs, len(base)):
            self.left[i], self.right[i] = number[mark(a)], number[mark(b)]
            self.merged[self.left[i], self.right[i]] = i
        self.size = [len(t) for t in self.texts]
        self.shorter: list[int | None] = []
        for t in self.texts:
            cut = next((number[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in number), None)
            self.shorter.append(cut)
        self.machine = ahocorasick.Automaton()
        for i, t in enumerate(self.texts):
            self.machine.add_word(t, i)
        self.machine.make_automaton()
        self.pairs: dict[tuple[int, int], bool] = {}

    def compatible(self, a: int, b: int) -> bool:
        """Whether merging the text of a and b gives a and b."""
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) > 4 * KEPT:
                self.pairs.clear()
            known = self.pairs[a, b] = self._stands(a, b)
        return known

    def _stands(self, a: int, b: int) -> bool:
        # x and y touch at the boundary; going back in time the younger falls
        # into its parts, and until then a merge across must not have come
        x, y, before = a, b, len(self.texts)
        while True:
            if self.merged.get((x, y), before) < before:
                return False
            if x > y:
                if self.left[x] == x:
                    return True
                before, x = x, self.right[x]
            else:
                if self.left[y] == y:
                    return True
                # of equal merges the left one comes first, and that is the one across
                before, y = y + 1, self.left[y]

    def encode(self, word: str) -> list[int]:
        """Token numbers of a word in byte letters, ended by END if the vocabulary marks ends."""
        n, at, out = len(word), 0, []
        alive = bytearray(b"\x01") * (n + 1)
        if word.endswith(self.END):
            alive[n - 1] = 0  # the mark belongs to the last letter
        search, size, shorter = self.machine.iter_long, self.size, self.shorter
        token = next(search(word, 0))[1] if n else None
        while token is not None:
            last = out[-1] if out else None
            while True:
                end = at + size[token]
                if alive[end] and (last is None or self.compatible(last, token)):
                    out.append(token)
                    at = end
                    token = next(search(word, at))[1] if at < n else None
                    break
                token = shorter[token]
                if token is None:
                    if last is None:
                        raise ValueError("the vocabulary cannot spell this word")
                    alive[at] = 0
                    out.pop()
                    at -= size[last]
                    token = last
                    break
        return out


class WordBpe:
    """Texts to ids and back, as the tokenizer file says.

    The file's own normalizer and splitter cut texts into words of byte letters
    (white space is dropped there); merging and decoding are done here.  The
    file has no decoder, so decoded tokens are parted by a space.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        model = told["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.merges = Merges(model["vocab"], model["merges"], self.suffix)
        parts = Tokenizer.from_file(path)
        self.normal, self.split = parts.normalizer, parts.pre_tokenizer
        self.special = {t["content"]: t["id"] for t in told["added_tokens"]}
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.words: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        strings = {i: t for t, i in (model["vocab"] | self.special).items()}
        blobs = [(strings.get(i, "") + " ").encode() for i in range(max(strings) + 1)]
        self.blob = np.frombuffer(b"".join(blobs), np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum([len(b) for b in blobs])])

    def _word(self, word: str) -> bytes:
        ids = self.words.get(word)
        if ids is None:
            tokens = self.merges.encode(word + self.merges.END if self.suffix else word)
            ids = np.array([self.merges.ids[t] for t in tokens], "<u4").tobytes()
            if len(word) <= LONG:
                if len(self.words) > KEPT:
                    self.words.clear()
                self.words[word] = ids
        return ids

    def _plain(self, text: str) -> bytes:
        words = self.split.pre_tokenize_str(self.normal.normalize_str(text))
        return b"".join([self._word(w) for w, _ in words])

    def _piece(self, text: str) -> bytes:
        if not self.cut.search(text):
            return self._plain(text)
        return b"".join(
            np.array([self.special[part]], "<u4").tobytes() if part in self.special
            else self._plain(part)
            for part in self.cut.split(text) if part
        )

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        pieces, out = self.pieces, []
        if len(pieces) > KEPT:
            pieces.clear()
        for text in texts:
            if any(c in text for c in _FILE_SEPARATORS):
                out.append(self._piece(text))
                continue
            parts = text.split()
            new = set(parts).difference(pieces)
            for part in new:
                pieces[part] = self._piece(part)
            out.append(b"".join([pieces[p] for p in parts]))
            for part in new:
                if len(part) > LONG:
                    del pieces[part]
        return out

    def decode(self, encoded: list[bytes]) -> list[bytes]:
        """UTF-8 of each text's tokens, by gathering from the table of all token texts."""
        ids = np.frombuffer(b"".join(encoded), "<u4").astype(np.int64)
        start, size = self.offsets[ids], self.offsets[ids + 1] - self.offsets[ids]
        ends = np.cumsum(size)
        where = np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - size), size)
        text, at, out = self.blob[where].tobytes(), 0, []
        n = np.cumsum([0, *(len(e) // 4 for e in encoded)])
        for i in range(len(encoded)):
            end = int(ends[n[i + 1] - 1]) if n[i + 1] else 0
            out.append(text[at : max(at, end - 1)])
            at = end
        return out


@lru_cache(maxsize=2)
def coder(path: str) -> WordBpe:
    """One coder per worker process and file."""
    return WordBpe(path)


def encode_texts(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, ids array<int>) per row; NULL counts as empty text."""
    return _apply(docs, tokenizer, id_col, text_col, "ids array<int>", lambda tool, texts: [
        pa.array([np.frombuffer(e, "<u4").astype(np.int32) for e in tool.encode(texts)],
                 pa.list_(pa.int32()))
    ])


def round_trip(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) per row.

    Digests of the ids as little-endian unsigned 32-bit integers and of the
    decoded text in UTF-8, in lower-case hex.  NULL and empty texts have no
    tokens and decode to empty text.  Rows stay where they are: nothing is
    shuffled.  The tokenizer file must be at that path on every machine; an
    empty table gives an empty result; other columns are ignored.
    """
    def digests(tool: WordBpe, texts: list[str]) -> list[pa.Array]:
        encoded = tool.encode(texts)
        hexes = [[hashlib.sha256(x).hexdigest() for x in each]
                 for each in (encoded, tool.decode(encoded))]
        return [pa.array([len(e) // 4 for e in encoded], pa.int64()), *map(pa.array, hexes)]

    return _apply(
        docs, tokenizer, id_col, text_col,
        "n_tokens bigint, ids_sha256 string, decoded_sha256 string", digests,
    )


def _apply(docs: DataFrame, tokenizer: str, id_col: str, text_col: str, fields: str, make) -> DataFrame:
    names = [id_col, *(f.split()[0] for f in fields.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in chunks(whole, "__text"):
                made = make(coder(tokenizer), batch.column("__text").to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column("__id"), *made], names)

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(
        F.col(id_col).alias("__id"), F.coalesce(text_col, F.lit("")).alias("__text")
    )
    return rows.mapInArrow(run, f"`{id_col}` {kind}, {fields}")
