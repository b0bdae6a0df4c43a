"""Importance resampling: draw the documents that look most like a target text set.

Features are runs of words, hashed into buckets. How much more often a bucket
occurs in the target than in the corpus is its gain; a document's weight is the
mean gain of its features, looked up in one array. With Gumbel noise added, the
highest scores are a draw without replacement in proportion to the weights. The
cutoff is found by quantile sketch: a bracket of scores around it, exact counts
outside that prove the bracket or widen it, and a sort of the bracket alone.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import small_batches, utf8_texts
from roadpulse.llm.numbering import ACCURACY, MARGIN, bracket, numbered
from roadpulse.sources.shared_dir import written

# Buckets, share drawn in a hundred, fewest words, seed, scale of the scores.
BUCKETS = 10_000
PERCENT = 25
FEWEST_WORDS = 20
SEED = 7
SCALE = 1000

_BLOCK = 1 << 20

# Letters, digits and all that is not ASCII stay, in lower case; the rest separates words.
_AS_WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


def _word_blocks(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text in order, about a megabyte of text at a time."""
    plain = text.translate(_AS_WORDS)
    start = 0
    while start < len(plain):
        end = plain.find(b" ", start + _BLOCK)
        end = len(plain) if end < 0 else end
        yield plain[start:end].split()
        start = end


def feature_blocks(text: bytes) -> Iterator[tuple[int, np.ndarray]]:
    """Per block of a text: number of words, and CRC-32 of the words and of the pairs that end in it."""
    last = None
    for words in _word_blocks(text):
        if not words:
            continue
        single = list(map(zlib.crc32, words))
        spaced = map(zlib.crc32, repeat(b" "), single if last is None else [last, *single])
        pairs = map(zlib.crc32, words[1:] if last is None else words, spaced)
        last = single[-1]
        yield len(words), np.fromiter([*single, *pairs], np.uint32)


def bucket_counts(texts: DataFrame, text: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): features of all texts per bucket; every task sends at most one row per bucket."""
    rows = texts.select(F.col(text).alias("_text"))

    def work(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in small_batches(batches, "_text", 4 << 20):
            for one in utf8_texts(batch.column(0)):
                for _, found in feature_blocks(one):
                    total += np.bincount(found % buckets, minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(total[held])], names=["bucket", "n"])

    return rows.mapInArrow(work, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS, scale: int = SCALE) -> np.ndarray:
    """Gain of each bucket from the two ``bucket_counts`` (an action each); the driver gets ``buckets`` rows."""
    s, t = ({r["bucket"]: r["n"] for r in counts.collect()} for counts in (corpus, target))
    all_s, all_t = float(sum(s.values()) + buckets), float(sum(t.values()) + buckets)
    return np.array(
        [math.floor(scale * math.log((t.get(b, 0) + 1.0) * all_s / ((s.get(b, 0) + 1.0) * all_t))) for b in range(buckets)], np.int64
    )


def gumbel(seed: int, doc_id: object, scale: int = SCALE) -> int:
    """Noise that follows from the seed and the id alone."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-scale * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(
    docs: DataFrame, gains: np.ndarray, doc_id: str = "doc_id", text: str = "text", seed: int = SEED, scale: int = SCALE
) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of every document (lazy)."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_words", "n_features", "weight", "score"]

    def work(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in small_batches(batches, "_text", 4 << 20):
            columns: list[list[int]] = [[], [], [], []]
            for one, key in zip(utf8_texts(batch.column(1)), batch.column(0).to_pylist()):
                n_words = n_features = gained = 0
                for n, found in feature_blocks(one):
                    n_words += n
                    n_features += len(found)
                    gained += int(gains[found % len(gains)].sum())
                weight = gained // n_features if n_features else 0
                for column, value in zip(columns, (n_words, n_features, weight, weight + gumbel(seed, key, scale))):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, pa.int64()) for c in columns]], names=names)

    return rows.mapInArrow(work, f"doc_id {id_type}, " + ", ".join(f"{c} long" for c in names[1:]))


def _order() -> list[Column]:
    """Best first; the rows' own numbers make the order total, repeated rows too."""
    return [
        (-F.col("score")).alias("a"),
        F.col("doc_id").isNull().alias("b"),
        F.col("doc_id").alias("c"),
        F.col("n_features").alias("d"),
        F.col("_row").alias("e"),
    ]


def drawn(rows: DataFrame, wanted: int, total: int, margin: float = MARGIN, accuracy: int = ACCURACY) -> Column:
    """Whether a row is among the ``wanted`` first in order (several actions): a condition on stored rows."""
    if not wanted:
        return F.lit(False)
    found = bracket(rows, wanted, total, margin, accuracy)
    inside = rows.filter(F.col("score").between(found.low, found.high))
    last = numbered(inside.select("doc_id", "n_features", "score", "_row"), _order(), "resampling-bracket")
    cut = last.filter(F.col("number") == wanted - found.above).select(F.struct(*_order()).alias("k")).head()["k"]
    id_type = rows.schema["doc_id"].dataType
    # Neither the number of features nor the row's own is ever null; ids compare only where both have one.
    same_id = F.col("doc_id").eqNullSafe(F.lit(cut["c"]).cast(id_type))
    earlier_id = F.lit(False) if cut["c"] is None else F.col("doc_id") < F.lit(cut["c"]).cast(id_type)
    earlier_id = F.coalesce(earlier_id, F.lit(False)) | (F.col("doc_id").isNotNull() & F.lit(cut["b"]))
    earlier_row = (F.col("n_features") < cut["d"]) | ((F.col("n_features") == cut["d"]) & (F.col("_row") <= cut["e"]))
    return (F.col("score") > -cut["a"]) | ((F.col("score") == -cut["a"]) & (earlier_id | (same_id & earlier_row)))


def resample(
    docs: DataFrame,
    target: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    percent: int = PERCENT,
    fewest_words: int = FEWEST_WORDS,
    seed: int = SEED,
    buckets: int = BUCKETS,
    margin: float = MARGIN,
    accuracy: int = ACCURACY,
) -> DataFrame:
    """Every document's ``n_features``, ``weight``, ``score`` and ``rank`` among the drawn, else null (several actions).

    Of the documents with ``fewest_words`` words or more, ``percent`` in a hundred
    (rounded down) are drawn, best score first, ties to the smaller id.

    A null text has no words and an empty one none either: weight 0, the score is
    the noise. A null id is a text of its own in the noise (that of the seed alone)
    and comes after every other id in ties. Repeated rows are documents each, with
    ranks of their own. An empty corpus gives no rows; with an empty target every
    bucket's gain follows from the corpus alone. Other columns are not read, so
    their names cannot clash.
    """
    gains = bucket_gains(bucket_counts(docs, text, buckets), bucket_counts(target, target_text, buckets), buckets)
    rows = scored(docs, gains, doc_id, text, seed).withColumn("_row", F.monotonically_increasing_id())
    rows = written(rows, "resampling-scores")
    able = rows.filter(F.col("n_words") >= fewest_words)
    total = able.count()
    wanted = percent * total // 100
    taken = (F.col("n_words") >= fewest_words) & drawn(able, wanted, total, margin, accuracy)
    columns = ["doc_id", "n_features", "weight", "score"]
    ranked = numbered(rows.filter(taken).select(*columns, "_row"), _order(), "resampling-ranks", "rank")
    return ranked.select(*columns, "rank").unionByName(rows.filter(~taken).select(*columns, F.lit(None).cast("long").alias("rank")))
