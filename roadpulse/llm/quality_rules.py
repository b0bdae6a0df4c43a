"""Line-first cleaning: rules per line, then a verdict on what is left of the document."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import carried, small_batches, word_hashes

# Symbols, words in a repeated window, fewest words, most repeated words in a hundred.
SYMBOLS = "#*$%&|<>"
WINDOW = 8
FEWEST_WORDS = 20
MOST_REPEATED = 30

#: Words of a long line among which different ones are counted at once.
BLOCK = 1000

#: A document goes when its failing lines hold more than this many of a hundred words.
MOST_LOST = 50

SPACES = " \t\n\x0b\x0c\r"
SEPARATOR = re.compile("[|»›·•→]")
BOILERPLATE = re.compile(
    "all rights reserved|cookie policy|cookie settings|accept cookies|privacy policy|terms of use|terms of service"
    "|enable javascript|lorem ipsum|click here|subscribe to our newsletter|skip to content|powered by"
)

RULES = ("punctuation", "navigation", "boilerplate", "repeated")
ADDED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lost_words", *(f"n_{r}_lines" for r in RULES), "base_failed", "kept", "clean_text")
_SCHEMA = (
    ", ".join(f"{c} long" for c in ADDED[:-3]) + ", base_failed boolean, kept boolean, clean_text string"
)

_FACTOR = 0x9E3779B97F4A7C15


def failed_rule(line: str, seen: bool) -> str | None:
    """The first rule that a line with a word fails; ``seen``: it repeats an earlier line.

    navigation: three separators or more, with at most three words between them;
    punctuation: more than a tenth of its characters are symbols;
    boilerplate: stock phrases of web pages make up a quarter of its words or more;
    repeated: an earlier line again, or ``repeats_itself``.
    """
    words = line.encode().split()
    chars = len(line) - sum(line.count(c) for c in SPACES)
    separators = len(SEPARATOR.findall(line))
    if separators >= 3 and len(words) <= 3 * (separators + 1):
        return "navigation"
    if 10 * sum(line.count(c) for c in SYMBOLS) > chars:
        return "punctuation"
    if 4 * sum(len(phrase.split()) for phrase in BOILERPLATE.findall(line.lower())) >= max(1, len(words)):
        return "boilerplate"
    if seen or repeats_itself(words):
        return "repeated"
    return None


def repeats_itself(words: Sequence[bytes]) -> bool:
    """Eight words or more, of which under a fifth differ.

    That share falls with the length of any text, so of more than ``BLOCK`` words
    different ones are counted in every block, and a longer line also repeats
    itself if under a fifth differ in all and over half stand in repeated windows.
    """
    if len(words) < 8 or 5 * len(set(words)) >= len(words):
        return False
    if 5 * sum(len(set(words[k : k + BLOCK])) for k in range(0, len(words), BLOCK)) < len(words):
        return True
    return 2 * repeated_words(word_hashes([b" ".join(words)])[0]) > len(words)


def repeated_words(hashes: np.ndarray, window: int = WINDOW) -> int:
    """Words that lie in a window of ``window`` words found twice or more in the text."""
    n = len(hashes) - window + 1
    if n < 2:
        return 0
    with np.errstate(over="ignore"):
        at = np.zeros(n, np.uint64)
        for k in range(window):
            at = at * np.uint64(_FACTOR) + hashes[k : k + n]
    order = np.argsort(at, kind="stable")
    same = at[order[1:]] == at[order[:-1]]
    if not same.any():
        return 0
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    covered = np.zeros(len(hashes) + 1, np.int64)
    covered[:n] += twice
    covered[window : window + n] -= twice
    return int(np.count_nonzero(np.cumsum(covered[:-1])))


def judge(text: str | None, hashes: np.ndarray | None = None) -> tuple:
    """The values of ``ADDED`` for one text, ``hashes`` being those of its words; null counts as empty."""
    text = text or ""
    if hashes is None:
        (hashes,) = word_hashes([text.encode()])
    n_words = len(hashes)
    repeat = repeated_words(hashes)
    seen, keep, failed = set(), [], dict.fromkeys(RULES, 0)
    duplicates = lost = 0
    for line in text.split("\n"):
        if not line.strip(SPACES):
            keep.append(line)
            continue
        again = line in seen
        duplicates += again
        seen.add(line)
        rule = failed_rule(line, again)
        if rule:
            failed[rule] += 1
            lost += len(line.encode().split())
        else:
            keep.append(line)
    base_failed = n_words < FEWEST_WORDS or 100 * repeat > MOST_REPEATED * n_words
    return (
        n_words,
        len(text) - sum(text.count(c) for c in SPACES),
        sum(text.count(c) for c in SYMBOLS),
        duplicates,
        repeat,
        lost,
        *failed.values(),
        base_failed,
        not base_failed and 100 * lost <= MOST_LOST * n_words,
        "\n".join(keep),
    )


def clean_lines(docs: DataFrame, text: str = "text", carry: Sequence[str] | None = None, with_text: bool = True) -> DataFrame:
    """Every row with its counts, its verdict and the text without failing lines (lazy, no shuffle).

    Lines with no word are left in and never count. Null text is empty and fails
    as too short; an empty table gives an empty result. ``carry`` names the
    columns to return (all by default); one that has the name of an added column
    is left out. Without ``with_text`` the cleaned texts are not returned.
    """
    added = ADDED if with_text else ADDED[:-1]
    columns = carried(docs, docs.columns if carry is None else carry, ADDED)
    names = [f"_carried{i}" for i in range(len(columns))]
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(columns, names)], F.col(text).alias("_text"))
    schema = rows.drop("_text").schema.simpleString().removeprefix("struct<").removesuffix(">")
    types = [*[pa.int64()] * (len(ADDED) - 3), pa.bool_(), pa.bool_(), pa.string()][: len(added)]

    def work(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in small_batches(batches, "_text", 4 << 20):
            texts = [t or "" for t in batch.column(batch.schema.get_field_index("_text")).to_pylist()]
            hashes = word_hashes([t.encode() for t in texts])
            found = list(zip(*map(judge, texts, hashes))) or [()] * len(ADDED)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in range(len(names))], *[pa.array(v, t) for v, t in zip(found, types)]],
                names=[*names, *added],
            )

    out = rows.mapInArrow(work, f"{schema}, {_SCHEMA}" if schema and with_text else ", ".join(filter(None, [schema, _SCHEMA if with_text else _SCHEMA.removesuffix(", clean_text string")])))
    return out.select(*[F.col(n).alias(c) for n, c in zip(names, columns)], *added)


def cleaned_documents(docs: DataFrame, text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """Documents that stay, with their cleaned text and its length, and the columns of ``docs``."""
    names = docs.columns
    at = {n: f"c{i}" for i, n in enumerate(names)}
    kept = clean_lines(docs.toDF(*at.values()), at[text]).filter("kept")
    new = {text: F.col("clean_text"), n_chars: F.length("clean_text").cast("long")}
    return kept.select(*[new.get(n, F.col(c)).alias(n) for n, c in at.items()])
