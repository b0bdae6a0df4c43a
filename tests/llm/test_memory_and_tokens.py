"""What workers remember, whole words, and merges side by side."""

import random
import sys

import numpy as np
import pyarrow as pa
import pytest
from helpers import prose

from roadpulse.llm import best_fit_packing, quality_ranking, toxicity
from roadpulse.llm.byte_bpe import load_tokenizer, pieces
from roadpulse.llm.common import Remembered, word_hashes
from roadpulse.llm.pair_merges import PairTable, pair_merges


def test_a_memo_is_bounded_in_bytes():
    worked = []
    memo = Remembered(lambda key: worked.append(key) or len(key), most_bytes=1 << 20)
    for k in range(100_000):
        assert memo[f"{k:08d}" + "x" * (20_000 if k % 10 == 0 else 8)] > 0
        assert memo.held <= (1 << 20) + 200
    assert sum(sys.getsizeof(k) for k in memo) < 1 << 20
    assert memo["00000001" + "x" * 8] == 16 and len(worked) > 99_000


def test_pieces_are_remembered_within_a_bound(monkeypatch):
    vocabulary = best_fit_packing.Vocabulary(None)
    monkeypatch.setattr(best_fit_packing, "MOST_BYTES", 200_000)
    tokenizer = load_tokenizer()
    for k in range(40):
        texts = [prose(100 * k + j, 60) + " " + "Zq9" * 300 for j in range(10)]
        for text, ids in zip(texts, vocabulary.ids([pieces(t) for t in texts], 0)):
            assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids + [0]
        assert vocabulary.held < 500_000


def test_word_hashes_depend_on_the_word_alone():
    words = [b"a", b"b", b"ab", b"ba", b"x" * 47, b"x" * 48, b"x" * 49, b"y" * 5000, b"\x00", b"\x00\x00", "é中".encode()]
    alone = [int(word_hashes([w])[0][0]) for w in words]
    assert len(set(alone)) == len(words)
    (joined,) = word_hashes([b" \n\t".join(words)])
    assert joined.tolist() == alone
    several = word_hashes([b"", b" ", *words, b"ab a"])
    assert [len(x) for x in several] == [0, 0, *[1] * len(words), 2]
    assert several[-1].tolist() == [alone[2], alone[0]]
    assert word_hashes([]) == []


def test_whole_words_count():
    """Texts that differ beyond the 64th character of their words only."""
    one = " ".join("ab" * 40 + "!#!#" * k for k in range(2, 30))
    two = " ".join("ab" * 40 + "7.7." * k for k in range(2, 30))
    assert (quality_ranking.features(one) != quality_ranking.features(two))[quality_ranking._DENSE :].any()


def test_quality_quantile_is_that_of_all_documents(spark):
    """Also of those without a label and of texts too long for the fit."""
    rng = random.Random(2)
    rows = []
    for k in range(400):
        words = prose(k, 60 if k % 40 else 9000).split()
        share = rng.random()
        rows.append((k, " ".join(w + "%" if rng.random() < share else w for w in words), int(share < 0.6)))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(k, q) for k, _, q in rows if k % 3 == 0], "doc_id long, quality int")
    got = quality_ranking.quality_scores(docs.repartition(5), labels).collect()
    known = [q for k, _, q in rows if k % 3 == 0 and quality_ranking_fold(k) and len(rows[k][1]) <= 20_000]
    bad = known.count(0) / len(known)
    assert sum(r["predicted"] == 0 for r in got) == round(bad * 400)
    assert all((r["score"] >= 0.3) == bool(r["predicted"]) for r in got)


def quality_ranking_fold(k):
    import zlib

    return zlib.crc32(str(k).encode()) % 5 != 0


def test_margins_of_many_words_are_those_of_each():
    margins = np.random.default_rng(3).normal(size=toxicity.BUCKETS).astype(np.float32)
    words = ["", "a", "ab", "abcdefghij", "é中😀", "x" * 300, *prose(4, 200).split()]
    want = [margins[toxicity.subwords(w)].astype(np.float64).mean() for w in words]
    assert toxicity.word_margins(words, margins).tolist() == pytest.approx(want, rel=1e-12)
    assert len(toxicity.word_margins([], margins)) == 0


def test_pairs_are_found_among_colliding_ones():
    rng = np.random.default_rng(1)
    keys = rng.choice(1 << 20, 3000, replace=False)
    left, right = (keys >> 10).astype(np.int32), (keys & 1023).astype(np.int32)
    table = PairTable(left, right, np.arange(3000, dtype=np.int32) + 7)
    rank, merged = table.find(left, right)
    assert rank.tolist() == list(range(3000)) and merged.tolist() == list(range(7, 3007))
    absent = np.setdiff1d(np.arange(1 << 20), keys)[:5000]
    assert (table.find((absent >> 10).astype(np.int32), (absent & 1023).astype(np.int32))[0] == 2**31 - 1).all()


def test_merges_give_the_ids_of_the_library():
    merges, tokenizer = pair_merges(None), load_tokenizer()
    rng = random.Random(7)
    texts = ["", " ", "aaaa aaaaaaa aaaaa", "don't we'll  123 4567 !!!???", "日本語 テスト é", "x" * 3000, "ab" * 300, "\t\ttab\r\n \n", prose(1, 400)]
    texts += ["".join(rng.choice("aabbcdé e1.'\n") for _ in range(200)) for _ in range(200)]
    for text in texts:
        assert merges.knows(text)
        assert merges.ids(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text
    assert not merges.knows("a <|endoftext|> b")


def test_words_split_in_arrow_give_the_librarys_ids(monkeypatch):
    """Different words of a batch are told apart in Arrow; only texts with other white space are cut one by one."""
    texts = [
        None, "", " ", "\n", "\n\n", "a", " a", "a ", "a b", "a  b", "a\nb", "a \nb", "a\n b", "\na b", "a b\n", "b a b a a b",
        "tab\there two", "no break one", "a b c", "a\x1cb c", "one <|endoftext|> two", "<|endoftext|>", "it's 12 o'clock -- naïve 你好 \U0001f600",
        "word " * 500 + "end", "x\r\ny z",
    ]
    tokenizer = load_tokenizer()
    cut = []
    monkeypatch.setattr(best_fit_packing, "pieces", lambda t: cut.append(t) or pieces(t))
    vocabulary = best_fit_packing.Vocabulary(None)
    for part in (texts, texts[::-1], texts[3:9], [], [None]):
        column = pa.array(["x", *part], pa.string()).slice(1)
        found = vocabulary.ids_of_column(column, 0)
        assert [i.tolist() for i in found] == [[*tokenizer.encode(t or "", add_special_tokens=False).ids, 0] for t in part]
    assert not {"a b", "a\nb", "b a b a a b", "word " * 500 + "end"} & set(cut)
