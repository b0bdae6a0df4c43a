"""The text operators against plain versions, and on awkward tables."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from helpers import WORD, awkward, awkward_rows, brute_components, empty, prose
from tokenizers import Tokenizer

from roadpulse.llm import (
    best_fit_packing,
    exact_dedup,
    jaccard_join,
    license_scan,
    quality_rules,
    source_mix,
    token_counts,
)
from roadpulse.llm.byte_bpe import pieces

TOKENIZER = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def texts(spark, small):
    rows = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    return {r["doc_id"]: r["text"] for r in rows}


# Exact copies


def test_exact_dedup_of_awkward_rows(spark):
    got = exact_dedup.exact_dedup(awkward(spark), carry=["doc_id", "kept", "lang"]).collect()
    assert exact_dedup.exact_dedup(awkward(spark), carry=["doc_id", "kept"]).columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert len(got) == len(awkward_rows())
    groups = defaultdict(list)
    for r in got:
        groups[r["text_sha256"]].append(r)
    for rows in groups.values():
        assert sum(r["kept"] for r in rows) == 1
        assert {r["group_size"] for r in rows} == {len(rows)}
        ids = [r["doc_id"] for r in rows if r["doc_id"] is not None]
        assert {r["keep_id"] for r in rows} == {min(ids, default=None)}
    # Document 1, 10 and one without id; no text three times; document 7 twice.
    assert Counter(len(g) for g in groups.values() if len(g) > 1) == Counter([3, 3, 2])
    assert exact_dedup.exact_dedup(empty(spark)).count() == 0


def test_exact_dedup_beyond_the_broadcast_bound(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    one = exact_dedup.exact_dedup(docs, carry=["doc_id"])
    two = exact_dedup.exact_dedup(docs, carry=["doc_id"], most_broadcast_words=0, slots_per_row=1)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))


def test_no_text_is_shuffled_beyond_the_broadcast_bound(spark, tiny, monkeypatch):
    plans = []
    real = exact_dedup.written

    def noted(df, label):
        mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        plans.append(df._jdf.queryExecution().explainString(mode))
        return real(df, label)

    monkeypatch.setattr(exact_dedup, "written", noted)
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        noted(exact_dedup.exact_dedup(docs, carry=["doc_id"], most_broadcast_words=0), "result")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    exchanges = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[([^]]*)\]", "\n".join(plans))
    assert len(exchanges) >= 4
    assert not [e for e in exchanges if "_norm" in e or "text#" in e]


def test_copies_of_a_third_of_the_table(spark):
    rows = [(k, "the same  text") for k in range(400)] + [(7, f"own {k}") for k in range(800)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    for most in (0, 10**6):
        got = exact_dedup.exact_dedup(docs, carry=["doc_id"], most_broadcast_words=most, slots_per_row=1).collect()
        assert len(got) == 1200
        assert sum(r["kept"] for r in got) == 801
        assert {(r["keep_id"], r["group_size"]) for r in got if r["group_size"] > 1} == {(0, 400)}


def test_deduplicated_keeps_columns(spark):
    df = awkward(spark)
    kept = exact_dedup.deduplicated(df)
    assert kept.columns == df.columns
    assert kept.count() == len({re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t, *_ in awkward_rows()})


# Mixing


@pytest.mark.parametrize("seed", [1, 2])
def test_mix_comes_near_its_targets(spark, seed):
    rng = np.random.default_rng(seed)
    rows = [(i, "w " * int(rng.integers(0, 60)), "en", f"s{rng.integers(0, 7)}" if rng.random() > 0.1 else None, 0) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = source_mix.mix_sources(df).collect()
    assert len(got) == len(rows)
    by_source = defaultdict(lambda: [0, 0, 0.0])
    of = {r[0]: r[3] for r in rows}
    for r in got:
        x = by_source[of[r["doc_id"]]]
        x[0] += r["taken"]
        x[1], x[2] = r["source_size"], r["target"]
        assert r["taken"] in (0, r["size"], 2 * r["size"])
    names = sorted((s for s in by_source if s is not None)) + [None]
    weights = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    budget, open_, targets = 1.5 * sum(x[1] for x in by_source.values()), set(names), {}
    while True:
        share = (budget - sum(targets.values())) / sum(weights[s] for s in open_)
        full = [s for s in open_ if share * weights[s] >= 2 * by_source[s][1]]
        if not full:
            break
        for s in full:
            targets[s] = 2 * by_source[s][1]
            open_.discard(s)
    targets |= {s: share * weights[s] for s in open_}
    for s, (taken, _, target) in by_source.items():
        assert target == pytest.approx(targets[s], abs=1e-5)
        assert abs(taken - target) <= 30
    again = source_mix.mix_sources(df.repartition(5)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_mix_of_awkward_rows(spark):
    got = source_mix.mix_sources(awkward(spark)).collect()
    assert len(got) == len(awkward_rows())
    assert source_mix.mix_sources(empty(spark)).count() == 0
    mixed = source_mix.mixed_documents(awkward(spark))
    assert mixed.columns == awkward(spark).columns
    sizes = sum(len(WORD.findall(r["text"] or "")) for r in mixed.collect())
    assert sizes == sum(r["taken"] for r in got)


# Quality rules


def _plain_rules(text):
    text = text or ""
    words = WORD.findall(text)
    windows = defaultdict(list)
    for i in range(len(words) - 7):
        windows[tuple(words[i : i + 8])].append(i)
    covered = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(covered),
        len(words) < 20 or 100 * len(covered) > 30 * len(words),
    )


def test_rule_counts_are_those_of_a_plain_version(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in texts.items()], "doc_id long, text string")
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    for r in quality_rules.clean_lines(df).collect():
        assert tuple(r[c] for c in base) == _plain_rules(texts[r["doc_id"]])
        assert r["n_lost_words"] == r["n_words"] - len(WORD.findall(r["clean_text"]))
        assert r["kept"] == (not r["base_failed"] and 2 * r["n_lost_words"] <= r["n_words"])


def test_lines_that_fail():
    rule = quality_rules.failed_rule
    assert rule("the a%%% of&&& it$$$ is***", False) == "punctuation"
    assert rule("Home | About us | Contact | Imprint", False) == "navigation"
    assert rule("Please accept our Privacy Policy to go on.", False) == "boilerplate"
    assert rule("A sentence of its own.", True) == "repeated"
    assert rule("word " * 20, False) == "repeated"
    assert rule("A sentence | with one separator in a line of words.", False) is None


def test_long_and_ordinary_lines_stay():
    rng = np.random.default_rng(4)
    known = [f"{w}{k % 40}" for k, w in enumerate(prose(9, 8000).split())]
    often = 1 / np.arange(1, len(known) + 1)
    words = [known[k] for k in rng.choice(len(known), 200_000, p=often / often.sum())]
    line = " ".join(words)
    assert 5 * len(set(words)) < len(words)
    judged = dict(zip(quality_rules.ADDED, quality_rules.judge(line)))
    assert judged["kept"] and judged["n_lost_words"] == 0 and judged["clean_text"] == line
    assert quality_rules.judge(line + " powered by steam and click here")[-2]
    rule = quality_rules.failed_rule
    assert rule("The pumps of the old works were powered by steam until the year it closed.", False) is None
    # Long lines that do repeat themselves: few words, one phrase, and a passage longer than a block.
    assert rule(" ".join(str(k) for k in rng.integers(0, 50, 20_000)), False) == "repeated"
    assert rule("buy now and pay later " * 4000, False) == "repeated"
    assert rule(" ".join(words[:1500] * 8), False) == "repeated"
    assert rule("Powered by Example. All rights reserved.", False) == "boilerplate"


def test_rules_keep_good_documents_and_drop_bad_ones(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    labels = spark.read.parquet(f"{small}/labels.parquet")
    found = quality_rules.clean_lines(docs, carry=["doc_id"]).join(labels, "doc_id").select("kept", "quality", "n_words").collect()
    good = [r["kept"] for r in found if r["quality"] == 1 and r["n_words"] >= 20]
    bad = [r["kept"] for r in found if r["quality"] == 0]
    assert sum(good) >= 0.97 * len(good)
    assert sum(bad) <= 0.1 * len(bad)


def test_rules_on_awkward_rows(spark):
    df = awkward(spark)
    assert quality_rules.clean_lines(df).count() == len(awkward_rows())
    assert quality_rules.clean_lines(empty(spark)).count() == 0
    cleaned = quality_rules.cleaned_documents(df)
    assert cleaned.columns == df.columns
    assert {r["doc_id"] for r in cleaned.collect()} == {1, 5, 6, 7, 8, 9, 10, None}


# Tokens


def test_piecewise_counts_are_those_of_the_library(spark, texts):
    some = [*texts.values(), *(t for _, t, *_ in awkward_rows())]
    some += ["  a\n\n b\t c", "\n", " ", "a　b  　c", "x <|endoftext|>", "<|endoftext|>\n<|endoftext|>", "᠎ a", "a\x85b \x1f c", "é \U0001f600‍", "'s 'S it's'll \n's"]
    counter = token_counts.whole_tokens()
    want = TOKENIZER.encode_batch([t or "" for t in some], add_special_tokens=False)
    assert [counter.count(t) for t in some] == [len(e.ids) for e in want]
    assert all("".join(pieces(t or "")) == (t or "") for t in some)


def test_every_character_in_any_place():
    """Pieces and whole-token counts agree with the library whatever the character."""
    counter = token_counts.whole_tokens()
    chars = [chr(c) for c in [*range(0x3100), *range(0xA000, 0xABFF, 7), *range(0xFE00, 0x10000), *range(0x1F300, 0x1F700), *range(0x10000, 0x110000, 997)] if not 0xD800 <= c < 0xE000]
    some = [f"a{c} {c}b 1{c}1\n{c} {c}{c}  .{c}" for c in chars]
    want = TOKENIZER.encode_batch_fast(some, add_special_tokens=False)
    assert [counter.count(t) for t in some] == [len(e.ids) for e in want]


def test_counts_of_awkward_rows(spark):
    got = token_counts.token_counts(awkward(spark)).collect()
    want = [(i, len((t or "").encode()), len(TOKENIZER.encode(t or "").ids)) for i, t, *_ in awkward_rows()]
    assert Counter(tuple(r)[:3] for r in got) == Counter(want)
    assert all(r["over_limit"] == (r["n_tokens"] > 512) for r in got)
    assert token_counts.token_counts(empty(spark)).count() == 0


# Packing


def _check_packing(rows, texts_by_row, capacity):
    """Whole documents, right ids, gapless sequences."""
    want = Counter()
    for doc_id, text in texts_by_row:
        ids = np.array([*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        edge = (len(ids) - 1) % capacity + 1
        bounds = [0, *range(edge, len(ids) + 1, capacity)]
        for n, (a, b) in enumerate(zip(bounds, bounds[1:])):
            want[doc_id, n, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    held = defaultdict(list)
    for r in rows:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for spans in held.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    return len(held)


def _best_fit(lengths, capacity):
    """Best-fit, longest first, one document at a time."""
    gaps = []
    for length in sorted(lengths, reverse=True):
        fitting = [k for k, g in enumerate(gaps) if g >= length]
        if fitting:
            gaps[min(fitting, key=gaps.__getitem__)] -= length
        else:
            gaps.append(capacity - length)
    return len(gaps)


def test_packing_holds_all_ids_in_few_sequences(spark, small, texts):
    rows = best_fit_packing.pack_documents(spark.read.parquet(f"{small}/documents.parquet")).collect()
    n = _check_packing(rows, list(texts.items()), 2048)
    assert n == _best_fit([r["length"] for r in rows], 2048)
    assert n <= 1.01 * -(-sum(r["length"] for r in rows) // 2048) + 1


@pytest.mark.parametrize("capacity", [16, 2048])
def test_packing_of_awkward_rows(spark, capacity):
    rows = best_fit_packing.pack_documents(awkward(spark), capacity=capacity).collect()
    _check_packing(rows, [(i, t) for i, t, *_ in awkward_rows()], capacity)
    assert best_fit_packing.pack_documents(empty(spark)).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_supersteps_are_best_fit(spark, seed):
    rng = np.random.default_rng(seed)
    capacity = int(rng.integers(8, 120))
    lengths = rng.integers(1, 1 + int(rng.integers(2, capacity)), 400).tolist()
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lengths)], "item long, length long")
    rows = best_fit_packing.best_fit(df, capacity).collect()
    assert sorted(r["item"] for r in rows) == list(range(400))
    assert len({r["sequence_id"] for r in rows}) == _best_fit(lengths, capacity)


# Similarity


def test_components_are_those_of_all_pairs(spark, small, texts):
    ids = sorted(texts)
    want = {i: (n, ids[c]) for i, (n, c) in zip(ids, brute_components([texts[i] for i in ids]))}
    got = jaccard_join.jaccard_components(spark.read.parquet(f"{small}/documents.parquet")).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want


@pytest.mark.parametrize("seed", range(3))
def test_components_of_chains_and_near_copies(spark, seed):
    """Groups around a text, chains that drift away from it, and a passage that all hold."""
    rng = np.random.default_rng(seed)
    passage = prose(99, 30)
    rows = []
    for g in range(6):
        words = prose(100 * seed + g, int(rng.integers(20, 120))).split()
        for k in range(25):
            copy = list(words)
            for _ in range(int(rng.integers(0, 1 + len(copy) // 40))):
                copy[int(rng.integers(0, len(copy)))] = f"edit{rng.integers(0, 9)}"
            if g % 2:
                words = copy
            rows.append(" ".join(copy) + (" " + passage if k % 3 == 0 else ""))
    rows += [passage + " " + prose(7 + k, int(rng.integers(1, 12))) for k in range(40)]
    rows = [rows[i] for i in rng.permutation(len(rows))]
    got = jaccard_join.jaccard_components(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == dict(enumerate(brute_components(rows)))


def test_similarity_of_awkward_rows(spark):
    got = jaccard_join.jaccard_components(awkward(spark)).collect()
    assert len(got) == len(awkward_rows())
    component = {r["doc_id"]: r["component_id"] for r in got if r["doc_id"] is not None}
    assert [component[i] for i in (1, 5, 6, 7, 8, 9, 10, 11, 12)] == [1, 1, 1, 7, 8, 8, 1, 11, 11]
    assert [component[i] for i in (2, 3, 4)] == [2, 3, 4]
    assert {r["component_id"] for r in got if r["doc_id"] is None} == {1, None}
    assert jaccard_join.jaccard_components(empty(spark)).count() == 0
    left = jaccard_join.one_of_each(awkward(spark))
    assert left.columns == awkward(spark).columns
    assert Counter(r["doc_id"] for r in left.collect()) == Counter([1, 2, 3, 4, 7, 7, 8, 11, 13, 14, 15, None])


# Licences


def test_phrases_are_counted_wherever_they_stand(spark, texts):
    automaton = license_scan.standard_automaton()
    extra = ["MIT licence MIT License, cc-by CC  BY", "gnu general public license gnu general public", "Apache.License apache license", "", "cc by cc by"]
    for text in [*list(texts.values())[:400], *extra]:
        words = license_scan.words_of(text.encode())
        want = sorted(
            (i, label)
            for phrase, label in license_scan.PHRASES.items()
            for i in range(len(words))
            if words[i : i + len(phrase.split())] == phrase.encode().split()
        )
        assert sorted(automaton.scan(words).places) == want


def test_matching_statistics_and_chains():
    automaton = license_scan.LicenseAutomaton({"x y": "p"}, [("t", "a b c d e f g h i j"), ("u", "a b c d q r s t")])
    scan = lambda text: automaton.scan(text.encode().split(), shortest=3)
    assert scan("z a b c d e f g h i j z").spans == [license_scan.Span("t", 0, 1, 10, 10)]
    assert scan("a b c d z z f g h i z").spans[0].covered == 8
    assert scan("f g h i z a b c d").score == 0.5
    assert scan("x y z x y").places == [(0, "p"), (3, "p")]
    assert scan("a b z c d") == license_scan.Found(5, [], [], 0.0)


def test_licences_of_awkward_rows(spark):
    rows = [(1, "Released under the MIT License.", "own"), (2, None, None), (None, "nothing here", "own"), (3, "is under the Apache license and CC BY-NC 4.0", "own")]
    df = spark.createDataFrame(rows, "doc_id long, text string, labels string")
    got = {r["doc_id"]: r for r in license_scan.scan_licenses(df).collect()}
    assert (got[1]["n_base"], got[1]["first_word"], got[1]["base_labels"], got[1]["labels"], got[1]["score"]) == (1, 3, "mit", "mit", 1.0)
    assert (got[2]["n_words"], got[2]["first_word"], got[2]["labels"], got[2]["score"]) == (0, None, "", 0.0)
    assert got[3]["base_labels"] == "apache,cc-by" and got[3]["labels"] == "apache,cc-by,cc-by-nc"
    assert license_scan.scan_licenses(empty(spark)).count() == 0
    assert license_scan.scan_licenses(awkward(spark)).count() == len(awkward_rows())
