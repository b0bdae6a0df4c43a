"""Quality by Bradley-Terry pairwise ranking.

Each document has a strength, linear in its features. That a good document beats
a bad one has the probability that a logistic curve gives the difference of their
strengths; the weights minimise the logistic loss over preference pairs, that is
over feature differences. A strength is good from a quantile of the strengths on:
that of the share of bad documents among the labelled ones, over the strengths of
all documents.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import Remembered
from roadpulse.llm.labelled_sample import labelled_sample, remainder, scored
from roadpulse.llm.numbering import kth_highest
from roadpulse.sources.shared_dir import written

# Folds by CRC-32 of the id, the fold that is held out, score from which a document is good.
FOLDS = 5
HELD_OUT = 0
GOOD_FROM = 0.3

#: Preference pairs per fit, buckets of word shapes, gradient steps, rate and weight decay.
PAIRS = 30_000
SHAPES = 96
STEPS = 300
RATE = 0.05
DECAY = 1e-3

_LETTERS = re.compile(r"[^\W\d_]+")
_DIGITS = re.compile(r"\d+")


def shape(word: str) -> str:
    """Letters as ``a``, digits as ``0``, every other character as it is, runs once."""
    out = _DIGITS.sub("0", _LETTERS.sub("a", word))
    return "".join(c for i, c in enumerate(out) if not i or out[i - 1] != c)


_buckets = Remembered(lambda word: zlib.crc32(shape(word).encode("utf-8", "surrogatepass")) % SHAPES)
_DENSE = 14


def features(text: str | None) -> np.ndarray:
    """Statistics of the whole text, then the share of its words in each bucket of shapes."""
    text = text or ""
    out = np.zeros(_DENSE + SHAPES)
    words = text.split()
    n, chars = len(words), max(1, len(text))
    if not n:
        return out
    counts = Counter(words)
    lines = [x for x in text.split("\n") if x.strip()]
    letters = sum(map(len, _LETTERS.findall(text)))
    most = counts.most_common(1)[0][1]
    lengths = [len(w) for w in counts]
    out[:_DENSE] = (
        1.0,
        np.log1p(n),
        np.log1p(letters / n),
        letters / chars,
        sum(text.count(c) for c in ".,!?;:") / n,
        sum(text.count(c) for c in "#*$%&|<>{}[]~^_=+\\/") / n,
        len(counts) / n,
        np.log(len(counts)) - np.log1p(n),
        most / n,
        sum(a == b for a, b in zip(words, words[1:])) / n,
        1 - len(set(lines)) / max(1, len(lines)),
        np.log1p(n / max(1, len(lines))),
        np.log1p(max(lengths)),
        sum(w[-1] in ".!?" for w in words) / n,
    )
    for word, times in counts.items():
        out[_DENSE + _buckets[word]] += times / n
    return out


@dataclass
class Ranking:
    """Weights on standardised features, the strength at the threshold, the spread of strengths, the share of bad ones.

    The threshold is that of the fitted rows. Without both labels there is no share to take a quantile at.
    """

    middle: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    threshold: float
    width: float
    bad: float | None = None

    def strength(self, rows: np.ndarray) -> np.ndarray:
        return np.clip((rows - self.middle) / self.spread, -8, 8) @ self.weights

    def strengths(self):
        return lambda text: float(self.strength(features(text)))

    def scorer(self):
        at_threshold = np.log(GOOD_FROM / (1 - GOOD_FROM))

        def score(text: str | None) -> float:
            z = (self.strength(features(text)) - self.threshold) / self.width + at_threshold
            return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))

        return score


def fit(texts: Sequence[str], labels: Sequence[int], seed: int = 7) -> Ranking:
    """Weights by Adam on the logistic loss of preference pairs, in numpy.

    With only one label all strengths are equal, and every document is good or
    bad as that label says (good without any label).
    """
    rows = np.array([features(t) for t in texts]).reshape(len(texts), _DENSE + SHAPES)
    y = np.array(labels, np.int64)
    middle, spread = (rows.mean(0), rows.std(0)) if len(rows) else (np.zeros(_DENSE + SHAPES), np.ones(_DENSE + SHAPES))
    spread = np.where(spread < 1e-6, 1.0, spread)
    weights = np.zeros(rows.shape[1])
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):
        return Ranking(middle, spread, weights, 1.0 if len(bad) else -1.0, 1.0)
    x = np.clip((rows - middle) / spread, -8, 8)
    rng = np.random.default_rng(seed)
    first, second = rng.choice(good, PAIRS), rng.choice(bad, PAIRS)
    m, v = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, STEPS + 1):
        part = rng.integers(0, PAIRS, 4096)
        difference = x[first[part]] - x[second[part]]
        lose = 1 / (1 + np.exp(np.clip(difference @ weights, -40, 40)))
        gradient = DECAY * weights - (lose[:, None] * difference).mean(0)
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        weights -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    strength = x @ weights
    # Between the strongest of the bad share of documents and the weakest of the rest.
    ordered = np.sort(strength)
    threshold = (ordered[len(bad) - 1] + ordered[len(bad)]) / 2
    width = float(max(1e-6, np.median(strength[good]) - np.median(strength[bad]))) / 8
    return Ranking(middle, spread, weights, float(threshold), width, len(bad) / len(y))


def quality_scores(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """Per document: id, ``held_out``, ``score`` (0 to 1), ``predicted`` (fits in the driver, then several actions).

    The fit reads a bounded sample of labelled documents (``labelled_sample``)
    outside the held-out fold; every whole text has a strength, an empty or null one
    as one with no words. Strengths are written, and the quantile is that of all of
    them, exactly; only those around it are sorted. Rows without an id are never held out; labels that are
    null, or of no document, are not used; an empty table gives an empty result;
    other columns are not read.
    """
    sample = labelled_sample(docs, labels, label, remainder("_id", FOLDS) != HELD_OUT, doc_id, text)
    ranking = fit([t for t, _ in sample], [k for _, k in sample])
    held_out = F.coalesce(remainder(doc_id, FOLDS) == HELD_OUT, F.lit(False))
    rows = docs.select(F.col(doc_id).alias("doc_id"), held_out.alias("held_out"), F.col(text).alias("_text"))
    if ranking.bad is None:
        return scored(rows, ranking.scorer, GOOD_FROM)
    found = scored(rows, ranking.strengths, 0.0).drop("predicted").withColumn("_row", F.monotonically_increasing_id())
    found = written(found, "strengths")
    total = found.count()
    good = total - round(ranking.bad * total)
    if not total or not good:
        threshold = float("inf")
    else:
        threshold = kth_highest(found, good, total)
    z = (F.col("score") - F.lit(threshold)) / F.lit(ranking.width) + F.lit(float(np.log(GOOD_FROM / (1 - GOOD_FROM))))
    score = 1 / (1 + F.exp(-F.greatest(F.least(z, F.lit(40.0)), F.lit(-40.0))))
    # The document at the threshold is good, whatever its score is rounded to.
    is_good = F.col("strength") >= F.lit(threshold)
    judged = found.withColumn("strength", F.col("score")).withColumn("score", score)
    judged = judged.withColumn("score", F.when(is_good, F.greatest("score", F.lit(GOOD_FROM))).otherwise(F.col("score")))
    return judged.select("doc_id", "held_out", "score", (F.col("score") >= GOOD_FROM).cast("int").alias("predicted"))
