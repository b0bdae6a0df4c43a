"""Token counts by the whole-token shortcut."""

from __future__ import annotations

import functools
from collections.abc import Iterable

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.byte_bpe import load_tokenizer, pieces
from roadpulse.llm.common import Remembered, small_batches

# Tokens over which a document is long; the pattern that splits a text before merging.
LIMIT = 512
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class WholeTokens:
    """Counts the tokens of pieces of text.

    ``whole`` holds the vocabulary strings that are one pre-token and encode
    alone as one token, proven with the library when this is made. A pre-token
    among them counts as one; only the others are merged. The library's classes
    of characters can differ from those of ``regex``, so a character takes part
    once the library has been seen to split it in the same way.
    """

    def __init__(self, path: str | None = None):
        self.tokenizer = load_tokenizer(path)
        self.split = regex.compile(PATTERN).findall
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        decode = self.tokenizer.decoder.decode
        strings = [decode([t]) for t in self.tokenizer.get_vocab()]
        strings = [s for s in strings if s and "�" not in s and s not in self.special]
        encoded = self.tokenizer.encode_batch_fast(strings, add_special_tokens=False)
        self.whole = frozenset(s for s, e in zip(strings, encoded) if len(e.ids) == 1 and self.split(s) == [s])
        self.same: set[str] = set()
        self.merged = Remembered(lambda pre_token: len(self.tokenizer.encode(pre_token, add_special_tokens=False).ids))
        self.counted = Remembered(self._count)

    def _splits_alike(self, char: str) -> bool:
        """Whether the library puts ``char`` into the class that ``regex`` does.

        In these probes a letter, a number, white space and anything else split differently.
        """
        probe = f"a{char}a 1{char}1 .{char}. {char}{char}"
        spans, at = [], 0
        for part in self.split(probe):
            spans.append((at, at + len(part)))
            at += len(part)
        return [span for _, span in self.tokenizer.pre_tokenizer.pre_tokenize_str(probe)] == spans

    def _count(self, piece: str) -> int:
        new = set(piece) - self.same
        if new:
            self.same.update(c for c in new if self._splits_alike(c))
        if any(s in piece for s in self.special) or not self.same.issuperset(piece):
            return len(self.tokenizer.encode(piece, add_special_tokens=False).ids)
        return sum(1 if p in self.whole else self.merged[p] for p in self.split(piece))

    def count(self, text: str | None) -> int:
        return sum(map(self.counted.__getitem__, pieces(text or "")))


@functools.cache
def whole_tokens(path: str | None = None) -> WholeTokens:
    """One per Python worker."""
    return WholeTokens(path)


def token_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """Per document: id, ``n_bytes``, ``n_tokens``, ``over_limit`` (lazy, no shuffle).

    ``path`` names a byte-level BPE file of the tokenizers library; special
    strings inside texts count as it takes them by default. Null text is empty
    and has no tokens; repeated rows and null ids are returned as they are, an
    empty table gives an empty result, and other columns are not read.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        counter = whole_tokens(path)
        for batch in small_batches(batches, "_text"):
            texts = batch.column(1).to_pylist()
            n = [counter.count(t) for t in texts]
            n_bytes = [len((t or "").encode()) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(n, pa.int64()), pa.array([k > limit for k in n], pa.bool_())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return rows.mapInArrow(work, f"doc_id {id_type}, n_bytes long, n_tokens long, over_limit boolean")
