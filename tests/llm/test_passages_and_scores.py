"""Repeated passages and the two classifiers."""

import random
import zlib

import numpy as np
import pytest
from helpers import awkward, awkward_rows, empty, prose

from roadpulse.llm import quality_ranking, substring_dedup, toxicity
from roadpulse.llm.labelled_sample import labelled_sample, remainder

# Passages


def test_chunks_cover_a_text_and_survive_insertions():
    text = prose(5, 4000).encode()
    ends = substring_dedup.cuts(text)
    assert ends[-1] == len(text) and (np.diff(ends, prepend=0) > 0).all()
    chunks = lambda t: [t[a:b] for a, b in zip([0, *substring_dedup.cuts(t)], substring_dedup.cuts(t))]
    assert b"".join(chunks(text)) == text
    moved = text[:3000] + b"something new " + text[3000:]
    assert len(set(chunks(moved)) - set(chunks(text))) <= 4
    assert max(map(len, chunks(b"For " * 9000))) <= substring_dedup.LONGEST
    assert [len(substring_dedup.cuts(b"x" * n)) for n in (0, 1, 2, 15, 16, 17)] == [0, 1, 1, 1, 1, 1]


def test_planted_passages_are_found(spark):
    rng = random.Random(3)
    shared = [prose(1000 + k, 60) for k in range(20)]
    rows, holds = [], set()
    for i in range(200):
        words = prose(i, rng.randint(40, 400)).split()
        if i % 3 == 0:
            at = rng.randint(0, len(words))
            words[at:at] = shared[(i // 3) % 20].split()
            holds.add(i)
        rows.append((i, " ".join(words)))
    got = substring_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"] for r in got} == holds
    texts = {i: t.encode() for i, t in rows}
    for r in got:
        span = texts[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert r["length"] >= 100 and r["n_copies"] >= 2
        assert any(span in t for i, t in texts.items() if i != r["doc_id"])
    assert 0 < sum(r["is_first"] for r in got) < len(got)


def test_passages_of_awkward_rows(spark):
    got = substring_dedup.repeated_passages(awkward(spark)).collect()
    assert {r["doc_id"] for r in got} >= {None, 1, 6, 7, 8, 9}
    whole = {r["doc_id"]: r["length"] for r in got}
    assert whole[8] >= len(awkward_rows()[7][1]) - 200
    assert substring_dedup.repeated_passages(empty(spark)).count() == 0


# The sample


def test_the_sample_is_bounded_and_of_the_training_folds(spark, small):
    docs, labels = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "labels"))
    training = remainder("_id", 5) != 0
    sample = labelled_sample(docs, labels, "quality", training, rows=100, chars=5000)
    assert 60 <= len(sample) <= 100 and all(len(t) <= 5000 for t, _ in sample)
    trained = {r["text"] for r in docs.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 5}
    assert all(t in trained for t, _ in sample)
    both = labelled_sample(docs, labels, "toxic", training, balanced=True, rows=40)
    assert 10 <= sum(k for _, k in both) <= 20
    assert labelled_sample(docs, labels.limit(0), "toxic", training, balanced=True) == []


# Quality


@pytest.mark.parametrize(
    "scores, label, parts, fold, accuracy",
    [(quality_ranking.quality_scores, "quality", 5, 0, 0.97), (toxicity.toxicity_scores, "toxic", 3, 1, 0.85)],
)
def test_held_out_accuracy(spark, small, scores, label, parts, fold, accuracy):
    docs, labels = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "labels"))
    got = {r["doc_id"]: r for r in scores(docs, labels).collect()}
    assert len(got) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % parts == fold) for i, r in got.items())
    assert all(0 <= r["score"] <= 1 for r in got.values())
    least = 0.3 if label == "quality" else 0.7
    assert all(r["predicted"] == (r["score"] >= least) for r in got.values())
    held = [(got[r["doc_id"]]["predicted"], r[label]) for r in labels.collect() if got[r["doc_id"]]["held_out"]]
    assert sum(a == b for a, b in held) >= accuracy * len(held)


@pytest.mark.parametrize("scores", [quality_ranking.quality_scores, toxicity.toxicity_scores])
def test_scores_of_awkward_rows(spark, scores):
    labels = spark.createDataFrame([(i, i % 2, i % 2, "x") for i in range(20)] + [(None, 1, 1, "x"), (3, None, None, "x")], "doc_id long, quality int, toxic int, text string")
    got = scores(awkward(spark), labels).collect()
    assert len(got) == len(awkward_rows())
    assert all(0 <= r["score"] <= 1 and r["held_out"] is not None for r in got)
    assert scores(awkward(spark), labels.limit(0)).count() == len(awkward_rows())
    assert scores(empty(spark), labels).count() == 0


def test_ranking_orders_by_preference():
    good = [prose(k, 80) + "." for k in range(40)]
    bad = [" ".join(w + "%%%" for w in prose(100 + k, 80).split()) for k in range(10)]
    ranking = quality_ranking.fit(good + bad, [1] * 40 + [0] * 10)
    score = ranking.scorer()
    assert min(score(t) for t in good) >= 0.3 > max(score(t) for t in bad)
    assert 0 <= score("") <= 1 and 0 <= score(None) <= 1


def test_unseen_spellings_share_what_was_learnt():
    """Endings that training never had are recognised by the stem they share."""
    rng = random.Random(5)
    endings = [prose(200 + k, 1)[:4] for k in range(60)]

    def text(k, toxic, some):
        words = prose(k, 80).split()
        for _ in range(3 * toxic):
            words[rng.randint(0, 79)] = "grobian" + rng.choice(some)
        return " ".join(words)

    labels = [k % 4 == 0 for k in range(300)]
    model = toxicity.fit([text(k, t, endings[:30]) for k, t in enumerate(labels)], [int(t) for t in labels])
    score = model.scorer()
    unseen = [score(text(1000 + k, True, endings[30:])) for k in range(40)]
    clean = [score(text(2000 + k, False, endings)) for k in range(40)]
    assert sum(s >= 0.7 for s in unseen) >= 36
    assert sum(s < 0.7 for s in clean) >= 38
    assert score("") == 0.0 and score(None) == 0.0


# Each passage is kept once


def _dropped(text: bytes, spans) -> bytes:
    """What is left of a text without its later parts."""
    out, at = [], 0
    for r in sorted(spans, key=lambda r: r["start"]):
        if not r["is_first"]:
            out.append(text[at : r["start"]])
            at = r["start"] + r["length"]
    return b"\n".join([*out, text[at:]])


def test_every_passage_keeps_exactly_one_copy(spark):
    """Passages of which an unrelated earlier text has a little, and such that stand beside an earlier one."""
    passages = [prose(3000 + k, 120) for k in range(12)]
    rows = [(k, f"{prose(k, 40)} {p[300:380]} {prose(50 + k, 40)}") for k, p in enumerate(passages)]
    rows += [(100 + k, f"{prose(100 + k, 40)} {p} {prose(200 + k, 40)} {p}") for k, p in enumerate(2 * passages)]
    beside = [prose(4000 + k, 120) for k in range(12)]
    rows += [(200 + k, f"{passages[k % 12]} {b} {prose(300 + k, 40)}") for k, b in enumerate(2 * beside)]
    got = substring_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()
    left = b"\n".join(_dropped(t.encode(), [r for r in got if r["doc_id"] == i]) for i, t in rows)
    for p in passages + beside:
        assert left.count(p[120:-120].encode()) == 1
        assert sum(r["is_first"] and p[120:-120].encode() in t.encode()[r["start"] : r["start"] + r["length"]] for r in got for i, t in rows if i == r["doc_id"]) == 1
