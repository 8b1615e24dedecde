"""Ids of whole texts by a byte-level tokenizer file.

tiktoken merges the file's own vocabulary, whose ids are merge ranks, several
times faster than the tokenizers library.  Texts with characters beyond the
first Latin blocks, for which the two libraries' character tables could differ,
go to the tokenizers library itself.
"""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

_OTHER = re.compile(r"[^\t\n\r\x20-\x7e\xa0-ſ]")


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class ByteEncoder:
    """Encodes lists of texts to little-endian unsigned 32-bit ids."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        letters = byte_letters()
        special = {t["content"]: t["id"] for t in told["added_tokens"]}
        ranks = {
            bytes(letters[c] for c in token): i for token, i in told["model"]["vocab"].items()
            if token not in special
        }
        self.fast = tiktoken.Encoding(
            os.path.basename(path), pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
            special_tokens=special,
        )

    def encode(self, texts: list[str]) -> list[bytes]:
        out = []
        for text in texts:
            if _OTHER.search(text):
                ids = np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4")
            else:
                ids = self.fast.encode_to_numpy(text, allowed_special="all")
            out.append(ids.astype("<u4", copy=False).tobytes())
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> ByteEncoder:
    """One encoder per worker process and file."""
    return ByteEncoder(path)
