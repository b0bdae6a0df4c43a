"""Toxicity by subword-bag embeddings under a linear softmax, trained jointly.

A word is the mean of the vectors of its character n-grams, a passage of a few
words the mean of its words, and a linear softmax tells toxic passages from
others. So a misspelling or ending that training never had shares most of its
n-grams with words that it did. Labels are of whole documents: a document is as
toxic as its most toxic passages, and training finds the worst one in turns with
the vectors.

Since vectors are averaged and the softmax is linear, a word adds one number to
the margin of its passage. Scoring looks that number up per word.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import Remembered
from roadpulse.llm.labelled_sample import labelled_sample, remainder, scored

# Folds by CRC-32 of the id, the fold that is held out, score from which a document is toxic.
FOLDS = 3
HELD_OUT = 1
TOXIC_FROM = 0.7

#: Words of a passage, lengths of n-grams, rows of the embedding table, size of a vector.
PASSAGE = 5
GRAMS = (3, 4, 5, 6, 7)
BUCKETS = 1 << 18
SIZE = 16

ROUNDS = 4
EPOCHS = 3
BATCH = 512
RATE = 0.3

_WORD = re.compile(r"[^\W_]+")


def _crc_tables() -> list[np.ndarray]:
    """What a byte does to CRC-32, by the number of zero bytes that follow it (none to three)."""
    first = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        first = first >> np.uint32(1) ^ np.where(first & 1, np.uint32(0xEDB88320), np.uint32(0))
    tables = [first]
    for _ in range(3):
        tables.append(tables[-1] >> np.uint32(8) ^ first[tables[-1] & 255])
    return tables


_CRC = _crc_tables()

#: New words of which the margins are found at once.
NEW_WORDS = 20_000


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def subwords(word: str) -> list[int]:
    """Rows of the embedding table of a word and of its n-grams, edges marked."""
    marked = f"<{word}>".encode("utf-32-le", "surrogatepass")
    found = [zlib.crc32(marked) % BUCKETS]
    for size in GRAMS:
        found += [zlib.crc32(marked[i : i + 4 * size]) % BUCKETS for i in range(0, len(marked) - 4 * size + 1, 4)]
    return found


def word_margins(words: Sequence[str], margins: np.ndarray) -> np.ndarray:
    """Per word the mean of ``margins`` over its ``subwords``, all words at a time.

    CRC-32 goes over a character (four bytes) in one step, for the n-grams that
    begin at any place of any word at once; the n-grams of a size are those that
    end within their word.
    """
    marked = [f"<{w}>" for w in words]
    lengths = np.fromiter(map(len, marked), np.int64, len(marked))
    chars = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), "<u4")
    if not len(chars):
        return np.zeros(0)
    starts = np.cumsum(lengths) - lengths
    room = np.repeat(starts + lengths, lengths) - np.arange(len(chars))
    whole = [zlib.crc32(m.encode("utf-32-le", "surrogatepass")) % BUCKETS for m in marked]
    total, counts = margins[whole].astype(np.float64), np.ones(len(marked), np.int64)
    crc = np.full(len(chars), 0xFFFFFFFF, np.uint32)
    for size in range(1, GRAMS[-1] + 1):
        fit = len(chars) - size + 1
        if fit <= 0:
            break
        state = crc[:fit]
        state ^= chars[size - 1 :]
        state[:] = _CRC[3][state & 255] ^ _CRC[2][state >> 8 & 255] ^ _CRC[1][state >> 16 & 255] ^ _CRC[0][state >> 24]
        if size in GRAMS:
            value = np.where(room[:fit] >= size, margins[(state ^ np.uint32(0xFFFFFFFF)) % np.uint32(BUCKETS)], 0.0)
            total += np.add.reduceat(np.concatenate([value, np.zeros(len(chars) - fit)]), starts)
            counts += np.maximum(lengths - size + 1, 0)
    return total / counts


def best_passage(values: np.ndarray, passage: int = PASSAGE) -> tuple[int, float]:
    """Start and mean of the ``passage`` values in a row that have the largest mean."""
    if len(values) <= passage:
        return 0, float(values.mean()) if len(values) else -np.inf
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    means = (total[passage:] - total[:-passage]) / passage
    at = int(means.argmax())
    return at, float(means[at])


def document_features(values: np.ndarray, bias: float) -> np.ndarray:
    """What a document's score is made of: its worst passage, its worst words, its length.

    The longer a text, the higher its worst word by chance; the length makes up for it.
    """
    worst = np.sort(np.partition(values, -6)[-6:] if len(values) > 6 else values)[::-1] + bias
    worst = np.concatenate([worst, np.full(6, worst[-1])])[:6]
    return np.array([best_passage(values)[1] + bias, worst[0], worst[1:3].mean(), worst[3:6].mean(), np.log1p(len(values)), 1.0])


@dataclass
class Model:
    """Embedding rows already multiplied by the softmax's weights, and the scale of scores."""

    margins: np.ndarray
    bias: float
    scale: np.ndarray

    def scorer(self):
        margins = self.margins
        known = Remembered(lambda word: float(margins[subwords(word)].astype(np.float64).mean()))

        def prepare(texts: Sequence[str | None]) -> None:
            """Margins of the words of some texts that are new, many at a time."""
            new: set[str] = set()
            for text in texts:
                new.update(w for w in words_of(text) if w not in known and len(w) <= known.longest)
                if len(new) >= NEW_WORDS:
                    known.put(new, word_margins(list(new), margins).tolist())
                    new = set()
            known.put(new, word_margins(list(new), margins).tolist())

        def score(text: str | None) -> float:
            words = words_of(text)
            if not words:
                return 0.0
            values = np.fromiter(map(known.__getitem__, words), np.float64, len(words))
            z = float(document_features(values, self.bias) @ self.scale)
            return 1 / (1 + np.exp(-min(40.0, max(-40.0, z))))

        score.prepare = prepare
        return score


class _Words:
    """The distinct words of the sample, with their subwords in one flat array."""

    def __init__(self, texts: Iterable[str]):
        index: dict[str, int] = {}
        self.docs = [np.array([index.setdefault(w, len(index)) for w in words_of(t)], np.int64) for t in texts]
        parts = [subwords(w) for w in index]
        self.counts = np.array([len(p) for p in parts], np.int64)
        self.starts = np.cumsum(self.counts) - self.counts
        self.flat = np.array([s for p in parts for s in p], np.int64)

    def rows(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Subwords of the words one after the other, and where each word's begin."""
        counts = self.counts[words]
        begin = np.cumsum(counts) - counts
        return self.flat[np.repeat(self.starts[words] - begin, counts) + np.arange(counts.sum())], begin

    def values(self, per_row: np.ndarray) -> np.ndarray:
        """Per word the mean of its subwords' values."""
        return np.add.reduceat(per_row[self.flat], self.starts) / self.counts

    def vectors(self, words: np.ndarray, table: np.ndarray) -> np.ndarray:
        rows, begin = self.rows(words)
        return np.add.reduceat(table[rows], begin, axis=0) / self.counts[words, None]


def _passages(words: _Words, docs: Sequence[int], values: np.ndarray) -> list[np.ndarray]:
    """The best passage of each document by the values of its words."""
    found = []
    for d in docs:
        ids = words.docs[d]
        at, _ = best_passage(values[ids])
        found.append(ids[at : at + PASSAGE])
    return found


def fit(texts: Sequence[str], labels: Sequence[int], seed: int = 7) -> Model:
    """Vectors and softmax by logistic loss in numpy.

    Scores are scaled on what models of one half say about the other. Without
    both labels among texts that have words, every score is the share of toxic
    texts.
    """
    use = [i for i, t in enumerate(texts) if words_of(t)]
    y = np.array([labels[i] for i in use], np.int64)
    if min(np.count_nonzero(y == 1), np.count_nonzero(y == 0)) < 4:
        share = float(np.clip(np.mean(labels) if len(labels) else 0.0, 1e-3, 1 - 1e-3))
        return Model(np.zeros(BUCKETS, np.float32), 0.0, np.array([0, 0, 0, 0, 0, np.log(share / (1 - share))]))
    words = _Words([texts[i] for i in use])
    half = np.zeros(len(use), bool)
    for k in (0, 1):
        half[np.flatnonzero(y == k)[::2]] = True
    features = np.zeros((len(use), 6))
    for inside in (half, ~half):
        value, bias = _margins(words, *_train(words, np.flatnonzero(inside), y, seed))
        for d in np.flatnonzero(~inside):
            features[d] = document_features(value[words.docs[d]], bias)
    table, weights, bias = _train(words, np.arange(len(use)), y, seed)
    margins = (table @ (weights[1] - weights[0])).astype(np.float32)
    return Model(margins, float(bias[1] - bias[0]), _scale(features, y))


def _margins(words: _Words, table: np.ndarray, weights: np.ndarray, bias: np.ndarray) -> tuple[np.ndarray, float]:
    """What each word adds to the margin of toxic over other, and the softmax's own."""
    return words.values(table @ (weights[1] - weights[0])), float(bias[1] - bias[0])


def _first_guess(words: _Words, toxic: np.ndarray, clean: np.ndarray) -> np.ndarray:
    """Per word the best log-odds, by the documents that hold it, of a subword that three toxic ones hold."""
    held = np.zeros((2, BUCKETS))
    for k, docs in ((1, toxic), (0, clean)):
        for d in docs:
            held[k][np.unique(words.rows(np.unique(words.docs[d]))[0])] += 1
    odds = np.log((held[1] + 0.5) / (len(toxic) + 1)) - np.log((held[0] + 0.5) / (len(clean) + 1))
    odds[held[1] < 3] = 0.0
    return np.maximum.reduceat(odds[words.flat], words.starts)


def _train(words: _Words, learn: np.ndarray, y: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Table, weights and bias from the documents ``learn``."""
    rng = np.random.default_rng(seed)
    toxic, clean = learn[y[learn] == 1], learn[y[learn] == 0]
    value = _first_guess(words, toxic, clean)
    table = rng.normal(0, 0.1, (BUCKETS, SIZE)).astype(np.float32)
    weights = rng.normal(0, 0.1, (2, SIZE))
    bias = np.zeros(2)
    past = [np.full(BUCKETS, 1e-8), np.full((2, SIZE), 1e-8), np.full(2, 1e-8)]
    for _ in range(ROUNDS):
        positive = _passages(words, toxic, value)
        negative = _passages(words, clean, value)
        for d in np.concatenate([clean, clean]):
            at = int(rng.integers(0, max(1, len(words.docs[d]) - PASSAGE + 1)))
            negative.append(words.docs[d][at : at + PASSAGE])
        passages = positive + negative
        target = np.array([1] * len(positive) + [0] * len(negative))
        importance = np.where(target == 1, len(negative) / len(positive), 1.0) ** 0.5
        for _ in range(EPOCHS):
            order = rng.permutation(len(passages))
            for k in range(0, len(order), BATCH):
                part = order[k : k + BATCH]
                _step(words, [passages[i] for i in part], target[part], importance[part], table, weights, bias, past)
        value, _ = _margins(words, table, weights, bias)
    return table, weights, bias


def _step(words, passages, target, importance, table, weights, bias, past) -> None:
    """One Adagrad step of the table, the weights and the bias on some passages."""
    sizes = np.array([len(p) for p in passages])
    owner = np.repeat(np.arange(len(passages)), sizes)
    distinct, which = np.unique(np.concatenate(passages), return_inverse=True)
    vectors = words.vectors(distinct, table)
    x = np.zeros((len(passages), SIZE))
    np.add.at(x, owner, vectors[which] / sizes[owner, None])
    logits = x @ weights.T + bias
    p = np.exp(logits - logits.max(1, keepdims=True))
    p /= p.sum(1, keepdims=True)
    p[np.arange(len(target)), target] -= 1
    p *= (importance / importance.sum())[:, None]

    to_x = p @ weights
    to_word = np.zeros_like(vectors)
    np.add.at(to_word, which, to_x[owner] / sizes[owner, None])
    rows, _ = words.rows(distinct)
    counts = words.counts[distinct]
    touched, at = np.unique(rows, return_inverse=True)
    to_table = np.zeros((len(touched), SIZE))
    np.add.at(to_table, at, np.repeat(to_word / counts[:, None], counts, axis=0))

    past[0][touched] += (to_table**2).mean(1)
    table[touched] -= RATE * to_table / np.sqrt(past[0][touched])[:, None]
    for value, gradient, seen in ((weights, p.T @ x, past[1]), (bias, p.sum(0), past[2])):
        seen += gradient**2
        value -= RATE * gradient / np.sqrt(seen)


def _scale(features: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of a logistic curve through the labels, by Newton steps with a weak prior."""
    middle, spread = features.mean(0), features.std(0)
    middle[-1], spread = 0.0, np.where(spread < 1e-9, 1.0, spread)
    x = (features - middle) / spread
    at = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
        gradient = x.T @ (p - y) + 0.1 * at
        curve = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(at))
        at = at - np.clip(np.linalg.solve(curve, gradient), -2, 2)
    out = at / spread
    out[-1] -= out[:-1] @ middle[:-1]
    return out


def toxicity_scores(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """Per document: id, ``held_out``, ``score`` (0 to 1), ``predicted`` (fits in the driver, then lazy, no shuffle).

    The fit reads a bounded sample of labelled documents (``labelled_sample``)
    outside the held-out fold; every whole text is scored. Texts without words
    score 0; rows without an id are never held out; labels that are null, or of
    no document, are not used; an empty table gives an empty result; other columns
    are not read.
    """
    sample = labelled_sample(docs, labels, label, remainder("_id", FOLDS) != HELD_OUT, doc_id, text, balanced=True)
    model = fit([t for t, _ in sample], [k for _, k in sample])
    held_out = F.coalesce(remainder(doc_id, FOLDS) == HELD_OUT, F.lit(False))
    rows = docs.select(F.col(doc_id).alias("doc_id"), held_out.alias("held_out"), F.col(text).alias("_text"))
    return scored(rows, model.scorer, TOXIC_FROM)
