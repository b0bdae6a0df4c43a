"""Awkward tables, and plain versions of what the operators compute."""

import random
import re
from itertools import combinations

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdeghilmnorstu") for _ in range(rng.randint(2, 8))) for _ in range(n))


def awkward_rows():
    """Nulls in every column, empty, blank and long texts, ties, repeated rows, near copies."""
    base = prose(1, 120)
    words = base.split()
    near = " ".join(words[:60] + ["changed"] + words[61:])
    far = " ".join(words[:60] + prose(2, 60).split())
    long = prose(3, 9000)
    rows = [
        (1, base, "en", "b", None),
        (2, None, "en", "a", 0),
        (3, "", None, "a", 0),
        (4, " \n\t ", "en", None, 4),
        (5, base.upper(), "en", "c", 1),
        (6, near, "de", "a", 1),
        (7, far, "de", "a", 1),
        (7, far, "de", "a", 1),
        (8, long, "en", "b", len(long)),
        (9, long + " tail", "en", "b", None),
        (None, base, "en", "b", 3),
        (None, None, None, None, None),
        (10, base.replace(" ", "\n ", 3), "fr", "c", 2),
        (11, "one two", "fr", "c", 2),
        (12, "One  TWO", "fr", "c", 2),
        (13, "Éa ñ 中文 <|endoftext|> don't   stop\r\n\x1c x 12345", "fr", "d", 2),
        (14, "tie " * 50, "fr", "d", 2),
        (15, "For " * 400, "fr", "d", 2),
    ]
    return rows


def awkward(spark):
    """The awkward rows, with columns that have the names of results."""
    df = spark.createDataFrame(awkward_rows(), SCHEMA)
    for clash in ("kept", "score", "length", "n_words", "label", "v", "word", "size", "Group_Size"):
        df = df.selectExpr("*", f"'own' AS `{clash}`")
    return df


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def shingles(text, words=4):
    found = WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))
    if not found:
        return set()
    size = min(words, len(found))
    return {tuple(found[i : i + size]) for i in range(len(found) - size + 1)}


def brute_components(texts, percent=85):
    """Per text: size of its set and the smallest position reachable by links."""
    sets = [shingles(t) for t in texts]
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    holders = {}
    for i, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(i)
    pairs = {p for who in holders.values() for p in combinations(who, 2)}
    for i, j in pairs:
        both = len(sets[i] & sets[j])
        if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
            a, b = sorted((root(i), root(j)))
            parent[b] = a
    return [(len(s), root(i)) for i, s in enumerate(sets)]
