"""The pipeline, stage by stage, against plain versions."""

import re
from collections import Counter, defaultdict

import pytest
from helpers import WORD, awkward, empty

import corpus_pipeline
from roadpulse.llm import quality_rules


def _stages(spark, docs, sf_dir, tmp):
    """Rows in and out of every stage, each written and read again."""
    found = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{tmp}/{k}")
        after = spark.read.parquet(f"{tmp}/{k}")
        found.append((name, docs, after))
        docs = after
    return found


@pytest.fixture(scope="module")
def stages(spark, small, tmp_path_factory):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    return {n: (a, b) for n, a, b in _stages(spark, docs, small, tmp_path_factory.mktemp("stages"))}


def test_stages_in_order(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "exact_dedup", "jaccard_join", "source_mix", "best_fit_packing"]
    for name, (before, after) in stages.items():
        if name != "best_fit_packing":
            assert after.columns == before.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_cleaning_stage(stages):
    before, after = stages["quality_rules"]
    judged = {r["doc_id"]: quality_rules.judge(r["text"]) for r in before.collect()}
    got = {r["doc_id"]: r for r in after.collect()}
    assert set(got) == {i for i, j in judged.items() if j[-2]}
    assert all(r["text"] == judged[i][-1] and r["n_chars"] == len(r["text"]) for i, r in got.items())


def test_exact_stage(stages):
    before, after = stages["exact_dedup"]
    least = {}
    for r in before.collect():
        text = re.sub(r"[\x20\x09-\x0D]+", " ", r["text"])
        least[text] = min(r["doc_id"], least.get(text, r["doc_id"]))
    assert Counter(r["doc_id"] for r in after.collect()) == Counter(least.values())


def test_near_copy_stage(stages):
    before, after = stages["jaccard_join"]
    rows = sorted(before.collect(), key=lambda r: r["doc_id"])
    sets = []
    for r in rows:
        words = WORD.findall(r["text"].lower())
        sets.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))})
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    label = list(range(len(rows)))
    links = {(i, j) for who in holders.values() for i in who for j in who if i < j}
    links = [(i, j) for i, j in links if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    changed = True
    while changed:
        changed = False
        for i, j in links:
            low = min(label[i], label[j])
            changed |= label[i] != low or label[j] != low
            label[i] = label[j] = low
    assert sorted(r["doc_id"] for r in after.collect()) == [rows[i]["doc_id"] for i in sorted(set(label))]


def test_mix_and_pack_stages(stages):
    before, mixed = stages["source_mix"]
    total = sum(len(WORD.findall(r["text"])) for r in before.collect())
    taken = sum(len(WORD.findall(r["text"])) for r in mixed.collect())
    assert abs(taken - 1.5 * total) <= 0.05 * total
    times = Counter(r["doc_id"] for r in mixed.collect())
    assert max(times.values()) == 2
    packed = stages["best_fit_packing"][1].collect()
    assert Counter(r["doc_id"] for r in packed if r["piece"] == 0) == times
    held = Counter()
    for r in packed:
        held[r["sequence_id"]] += r["length"]
    assert max(held.values()) <= 2048
    assert len(held) <= 1.02 * sum(held.values()) / 2048 + 1


def test_run_gives_the_last_stage(spark, tiny):
    out = corpus_pipeline.run(spark, tiny)
    assert {"doc_id", "piece", "sequence_id", "offset"} <= set(out.columns)
    assert out.count() > 0


@pytest.mark.parametrize("make", [awkward, empty])
def test_stages_on_awkward_rows(spark, tmp_path, make):
    for _, before, after in _stages(spark, make(spark), "", tmp_path)[:-1]:
        assert after.columns == before.columns
        assert after.count() <= 2 * before.count()
