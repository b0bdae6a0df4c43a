"""Exact byte-level BPE of texts cut into pieces that encode independently.

The pre-tokenizer's pattern lets no token but one that begins with white space
contain any. So a text may be cut before every run of white space, and before a
single space that a word follows, and the pieces encode as the whole does.
Pieces repeat, so each is encoded once and remembered.
"""

from __future__ import annotations

import functools
import os
import re

TOKENIZER = "byte_bpe_50k.json"

# White space other than the plain space and line feed; more than the pattern's is harmless.
OTHER_SPACE = re.compile(r"[^\S \n]")
_PIECE = re.compile(r"\s*\S+|\s+")


def tokenizer_path(path: str | None) -> str:
    if path:
        return path
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


@functools.cache
def load_tokenizer(path: str | None = None):
    """The library's tokenizer, once per Python worker, on the task's own core."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path(path))
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def pieces(text: str) -> list[str]:
    """Pieces of a text, in order; their concatenation is the text."""
    if not text:
        return []
    if not OTHER_SPACE.search(text):
        parts = text.replace("\n", " \n").split(" ")
        if "" not in parts and "\n" not in parts:
            first = parts[0]
            out = [p if p[0] == "\n" else " " + p for p in parts]
            out[0] = first
            return out
    return _PIECE.findall(text)
