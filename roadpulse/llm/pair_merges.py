"""Byte-pair merges of many words side by side, in numpy.

Every round merges, in each word, its pair of lowest rank wherever it stands; a
word is done when none of its pairs has a rank. The ids are those that the
library gives, which goes word by word.
"""

from __future__ import annotations

import functools
import json

import numpy as np
import regex

from roadpulse.llm.byte_bpe import load_tokenizer, tokenizer_path

# Fixed value: the pattern that splits a text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_NO_RANK = np.int32(2**31 - 1)
_NONE = np.int64(-1)


class PairTable:
    """Rank and merged id of pairs of ids, looked up many at a time."""

    def __init__(self, left: np.ndarray, right: np.ndarray, merged: np.ndarray):
        self.shift = np.uint64(64 - max(4, int(16 * len(left)).bit_length()))
        size = 1 << (64 - int(self.shift))
        self.keys = np.full(size, _NONE)
        self.rank = np.full(size, _NO_RANK)
        self.merged = np.zeros(size, np.int32)
        keys = left.astype(np.int64) << 32 | right
        rank = np.arange(len(keys), dtype=np.int32)
        at = self._slot(keys)
        while len(keys):
            # Of several that want a slot the last gets it, if it is free; the others go on to the next.
            free = self.keys[at] == _NONE
            self.keys[at[free]] = keys[free]
            placed = self.keys[at] == keys
            self.rank[at[placed]], self.merged[at[placed]] = rank[placed], merged[placed]
            keys, rank, merged, at = keys[~placed], rank[~placed], merged[~placed], (at[~placed] + 1) % size

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * _FACTOR >> self.shift).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (``_NO_RANK`` if they do not merge) and merged id of each pair."""
        keys = left.astype(np.int64) << 32 | right
        at = self._slot(keys)
        held = self.keys[at]
        rank = np.where(held == keys, self.rank[at], _NO_RANK)
        merged = self.merged[at]
        on = np.flatnonzero((held != keys) & (held != _NONE))
        while len(on):
            at[on] = (at[on] + 1) % len(self.keys)
            held = self.keys[at[on]]
            hit = held == keys[on]
            rank[on[hit]], merged[on[hit]] = self.rank[at[on[hit]]], self.merged[at[on[hit]]]
            on = on[~hit & (held != _NONE)]
        return rank, merged


class PairMerges:
    """Token ids of texts by a byte-level BPE file of the tokenizers library.

    ``knows`` says of which texts: plain BPE files only, texts without special
    strings, and of characters that the library has been seen to split as
    ``regex`` does.
    """

    def __init__(self, path: str | None = None):
        with open(tokenizer_path(path), encoding="utf-8") as f:
            spec = json.load(f)
        model, split = spec["model"], spec.get("pre_tokenizer") or {}
        plain = model.get("type") == "BPE" and split == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": split.get("trim_offsets"), "use_regex": True}
        odd = ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")
        self.usable = plain and spec.get("normalizer") is None and not any(model.get(k) for k in odd)
        if not self.usable:
            return
        self.tokenizer = load_tokenizer(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = model["vocab"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        columns = [np.array([f(p) for p in pairs], np.int32) for f in (lambda p: vocabulary[p[0]], lambda p: vocabulary[p[1]], lambda p: vocabulary["".join(p)])]
        self.table = PairTable(*columns)
        # A byte is the one token of the character that stands for it.
        self.of_byte = np.array([vocabulary[c] for c in _byte_names()], np.int32)
        self.split = regex.compile(PATTERN).findall
        self.alike: set[str] = set()
        self.other: set[str] = set()

    def _splits_alike(self, char: str) -> bool:
        """In these probes a letter, a number, white space and anything else split differently."""
        probe = f"a{char}a 1{char}1 .{char}. {char}{char}"
        spans, at = [], 0
        for part in self.split(probe):
            spans.append((at, at + len(part)))
            at += len(part)
        return [span for _, span in self.tokenizer.pre_tokenizer.pre_tokenize_str(probe)] == spans

    def odd_characters(self, text: str) -> set[str]:
        chars = set(text)
        for char in chars - self.alike - self.other:
            (self.alike if self._splits_alike(char) else self.other).add(char)
        return chars & self.other

    def knows(self, text: str) -> bool:
        return self.usable and not any(s in text for s in self.special) and not self.odd_characters(text)

    def ids(self, text: str) -> np.ndarray:
        """Ids of a text that ``knows`` holds of."""
        words = self.split(text)
        data = np.frombuffer(text.encode(), np.uint8)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        if not text.isascii():
            # From characters to bytes.
            ends = np.append(np.flatnonzero(data & 0xC0 != 0x80), len(data))[ends]
        return self.merge(self.of_byte[data], np.diff(ends, prepend=0))

    def merge(self, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Ids after all merges, words of ``lengths`` ids one after the other."""
        out = np.full(len(ids), -1, np.int32)
        place = np.arange(len(ids), dtype=np.int32)
        first = np.zeros(len(ids), bool)
        first[np.cumsum(lengths) - lengths] = True
        rank = np.full(len(ids), _NO_RANK)
        merged = np.zeros(len(ids), np.int32)
        # Each id has the rank of the pair it makes with the next; the last of a word has none.
        at = np.flatnonzero(~first[1:])
        rank[at], merged[at] = self.table.find(ids[at], ids[at + 1])
        while len(ids):
            starts = np.flatnonzero(first)
            sizes = np.diff(starts, append=len(ids))
            least = np.minimum.reduceat(rank, starts)
            going = np.repeat(least != _NO_RANK, sizes)
            if not going.all():
                out[place[~going]] = ids[~going]
                ids, place, first, rank, merged = (x[going] for x in (ids, place, first, rank, merged))
                sizes, least = sizes[least != _NO_RANK], least[least != _NO_RANK]
                if not len(ids):
                    break
            hits = np.flatnonzero(rank == np.repeat(least, sizes))
            if len(hits) > 1:
                # In a run of equal ids ("aaaa") every other pair, from the left.
                new = np.diff(hits, prepend=-2) != 1
                runs = np.flatnonzero(new)
                hits = hits[(np.arange(len(hits)) - np.repeat(runs, np.diff(runs, append=len(hits)))) % 2 == 0]
            ids[hits] = merged[hits]
            stays = np.ones(len(ids), bool)
            stays[hits + 1] = False
            ids, place, first, rank, merged = (x[stays] for x in (ids, place, first, rank, merged))
            hits -= np.arange(len(hits))
            # The pairs that a merged id makes with its neighbours are new.
            new = np.zeros(len(ids), bool)
            new[hits] = new[hits[~first[hits]] - 1] = True
            changed = np.flatnonzero(new)
            last = changed + 1 >= len(ids)
            last[~last] = first[changed[~last] + 1]
            rank[changed[last]] = _NO_RANK
            changed = changed[~last]
            rank[changed], merged[changed] = self.table.find(ids[changed], ids[changed + 1])
        return out[out >= 0]


def _byte_names() -> list[str]:
    """The character that stands for each byte: itself if it prints, else the next one from 256 on."""
    printed = [*range(33, 127), *range(161, 173), *range(174, 256)]
    names = {b: chr(b) for b in printed}
    for k, b in enumerate(b for b in range(256) if b not in names):
        names[b] = chr(256 + k)
    return [names[b] for b in range(256)]


@functools.cache
def pair_merges(path: str | None = None) -> PairMerges:
    """One per Python worker."""
    return PairMerges(path)
