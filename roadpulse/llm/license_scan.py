"""Licence scan with a generalised suffix automaton over the words of licence notices.

Each text is streamed once through the automaton. After each word it is in the
state of the longest run of words, ending there, that stands in a template
(the matching statistic). A run that the next word does not lengthen is a long
match if it has ``SHORTEST`` words or is a whole template; matches of one
template that keep its order are chained, and the words of the template that a
chain covers decide. A chain ends where the text is done with its notice, so
several notices of one licence are several spans.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Mapping, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import carried, small_batches, utf8_texts
from roadpulse.llm.licenses import PHRASES, TEMPLATES

#: Fewest words of a match, and share of a template's words that a chain covers for its label.
SHORTEST = 4
COVERED = 0.6

#: Words between two matches of one notice at most, or as many as its template has.
FAR = 50

ADDED = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans")
_SPAN = "array<struct<label string, template int, first_word long, last_word long, covered int>>"

# Words are runs of ASCII letters, digits and characters beyond ASCII; A-Z lower-cased.
_TO_WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TO_WORDS).split()


class Span(NamedTuple):
    label: str
    template: int
    first_word: int
    last_word: int
    covered: int


class Found(NamedTuple):
    n_words: int
    places: list[tuple[int, str]]
    spans: list[Span]
    score: float


class LicenseAutomaton:
    """Suffix automaton of all templates and phrases together.

    Per state: length of its longest string, suffix link, transitions by word,
    per template all places where its strings end, and the phrases that its
    strings can end with.
    """

    def __init__(self, phrases: Mapping[str, str] = PHRASES, templates: Sequence[tuple[str, str]] = TEMPLATES):
        self.phrases = [(words_of(p.encode()), label) for p, label in phrases.items()]
        self.templates = [(words_of(t.encode()), label) for label, t in templates]
        self.length, self.link = [0], [-1]
        self.next: list[dict[bytes, int]] = [{}]
        self.ends: list[dict[int, set[int]]] = [{}]
        for number, (words, _) in enumerate([*self.templates, *self.phrases]):
            state = 0
            for at, word in enumerate(words):
                state = self._extend(state, word)
                self.ends[state].setdefault(number, set()).add(at)
        by_length = sorted(range(1, len(self.length)), key=self.length.__getitem__, reverse=True)
        for state in by_length:
            for number, at in self.ends[state].items():
                self.ends[self.link[state]].setdefault(number, set()).update(at)
        self.closing: list[list[tuple[int, str]]] = [[] for _ in self.length]
        for words, label in self.phrases:
            state = 0
            for word in words:
                state = self.next[state][word]
            self.closing[state].append((len(words), label))
        for state in reversed(by_length):
            self.closing[state] += self.closing[self.link[state]] if self.link[state] > 0 else []
        self.known = {word for step in self.next for word in step}

    def _copy(self, state: int, length: int) -> int:
        self.length.append(length)
        self.link.append(self.link[state])
        self.next.append(dict(self.next[state]))
        self.ends.append({})
        return len(self.length) - 1

    def _split(self, parent: int, word: bytes, child: int) -> int:
        """The state of the parent's longest string and ``word`` alone."""
        if self.length[child] == self.length[parent] + 1:
            return child
        own = self._copy(child, self.length[parent] + 1)
        self.link[child] = own
        while parent != -1 and self.next[parent].get(word) == child:
            self.next[parent][word] = own
            parent = self.link[parent]
        return own

    def _extend(self, last: int, word: bytes) -> int:
        if word in self.next[last]:
            return self._split(last, word, self.next[last][word])
        new = len(self.length)
        self.length.append(self.length[last] + 1)
        self.link.append(0)
        self.next.append({})
        self.ends.append({})
        state = last
        while state != -1 and word not in self.next[state]:
            self.next[state][word] = new
            state = self.link[state]
        if state != -1:
            self.link[new] = self._split(state, word, self.next[state][word])
        return new

    def scan(self, words: list[bytes], shortest: int = SHORTEST, covered: float = COVERED) -> Found:
        places: list[tuple[int, str]] = []
        matches: list[tuple[int, int, int]] = []
        known, step, link, length, closing = self.known, self.next, self.link, self.length, self.closing
        state = run = 0
        for at, word in enumerate(words):
            if word not in known:
                if run > 1:
                    matches.append((at - 1, run, state))
                state = run = 0
                continue
            if word not in step[state]:
                if run > 1:
                    matches.append((at - 1, run, state))
                while state and word not in step[state]:
                    state = link[state]
                run = length[state]
            state = step[state][word]
            run += 1
            for n, label in closing[state]:
                if n <= run:
                    places.append((at - n + 1, label))
        if run > 1:
            matches.append((len(words) - 1, run, state))
        spans = self._chains(matches, shortest, covered)
        score = max([1.0 if places else 0.0, *(s.covered / len(self.templates[s.template][0]) for s in spans)])
        spans = [s for s in spans if s.covered >= covered * len(self.templates[s.template][0])]
        return Found(len(words), places, spans, score)

    def _chains(self, matches: list[tuple[int, int, int]], shortest: int, covered: float) -> list[Span]:
        """The chains of every template, each the best of its stretch of the text."""
        found: list[Span] = []
        open_: dict[int, Chain] = {}
        for at, run, state in matches:
            for number, ends in self.ends[state].items():
                if number >= len(self.templates) or run < min(shortest, len(self.templates[number][0])):
                    continue
                words, label = self.templates[number]
                chain = open_.get(number)
                if chain and chain.is_over(at - run + 1, [e - run + 1 for e in ends], covered):
                    found.append(chain.best)
                    chain = None
                if not chain:
                    chain = open_[number] = Chain(number, label, len(words))
                chain.add(at, run, ends)
        return sorted(found + [c.best for c in open_.values()], key=lambda s: (s.template, s.first_word))


class Chain:
    """Matches of one template in one stretch of the text.

    ``upto[k]`` holds the most words of the template that matches cover which keep
    its order and end at its word ``k``, and the first word of the text in them.
    """

    def __init__(self, number: int, label: str, size: int):
        self.number, self.label = number, label
        self.upto = [(0, -1)] * size
        self.best: Span | None = None
        self.last = -1

    def is_over(self, start: int, places: list[int], covered: float) -> bool:
        """Whether a match that begins at ``start`` in the text belongs to another notice.

        It does if it is farther off than the template is long (and ``FAR`` words),
        or if the notice is covered well enough and the match goes on from none of
        what covers it, but begins anew.
        """
        if start - self.last > max(FAR, len(self.upto)):
            return True
        done = self.best.covered >= covered * len(self.upto)
        return done and not any(covers for place in places for covers, _ in self.upto[:place])

    def add(self, at: int, run: int, ends: Iterable[int]) -> None:
        new = []
        for end in ends:
            covers, first = max(self.upto[: end - run + 1], key=lambda e: e[0], default=(0, -1))
            new.append((end, (covers + run, first if covers else at - run + 1)))
        for end, entry in new:
            if entry[0] > self.upto[end][0]:
                self.upto[end] = entry
            if self.best is None or entry[0] > self.best.covered:
                self.best = Span(self.label, self.number, entry[1], at, entry[0])
        self.last = at


@functools.cache
def standard_automaton() -> LicenseAutomaton:
    """That of the known notices, one per Python worker."""
    return LicenseAutomaton()


def scan_licenses(docs: DataFrame, text: str = "text", carry: Sequence[str] | None = None) -> DataFrame:
    """Every row with what the scan finds in its whole text (lazy, no shuffle).

    ``n_base``, ``first_word`` and ``last_word`` count the places of the phrases
    and give their smallest and largest start; ``spans`` holds the chains that
    cover ``COVERED`` of their template or more, by template and place; ``labels`` those of both; ``score`` is
    the largest share of a template covered, 1 where a phrase stands. Null text
    is empty and has no label, score 0 and null places; an empty table gives an
    empty result. ``carry`` names the columns to return (all by default); one
    that has the name of an added column is left out.
    """
    columns = carried(docs, docs.columns if carry is None else carry, ADDED)
    names = [f"_carried{i}" for i in range(len(columns))]
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(columns, names)], F.col(text).alias("_text"))
    schema = rows.drop("_text").schema.simpleString().removeprefix("struct<").removesuffix(">")
    span_type = pa.struct([("label", pa.string()), ("template", pa.int32()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("covered", pa.int32())])
    types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(span_type)]

    def values(text: bytes) -> tuple:
        found = standard_automaton().scan(words_of(text))
        base = {label for _, label in found.places}
        starts = [start for start, _ in found.places] or [None]
        return (
            found.n_words,
            len(found.places),
            min(starts),
            max(starts),
            ",".join(sorted(base)),
            ",".join(sorted(base | {s.label for s in found.spans})),
            found.score,
            [s._asdict() for s in found.spans],
        )

    def work(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in small_batches(batches, "_text"):
            texts = utf8_texts(batch.column(len(names)))
            found = list(zip(*map(values, texts))) or [()] * len(ADDED)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(names)], *[pa.array(v, t) for v, t in zip(found, types)]], names=[*names, *ADDED]
            )

    added = f"n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans {_SPAN}"
    out = rows.mapInArrow(work, ", ".join(filter(None, [schema, added])))
    return out.select(*[F.col(n).alias(c) for n, c in zip(names, columns)], *ADDED)
