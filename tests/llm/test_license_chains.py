"""Several notices in one text, and matching statistics against a plain search."""

import random

from roadpulse.llm import license_scan
from roadpulse.llm.license_scan import LicenseAutomaton, Span, standard_automaton, words_of

TEMPLATES = [("t", "a b c d e f g h i j"), ("u", "k l m n a b c d"), ("v", "p q p q r p q r s t u v")]


def plain_matches(templates, words):
    """Every run of words that stands in a template, that no earlier word lengthens at its place and the next one does not go on."""
    runs = {tuple(t[i:j]) for t in templates for i in range(len(t)) for j in range(i + 1, len(t) + 1)}

    def longest(at):
        return max((n for n in range(1, at + 2) if tuple(words[at - n + 1 : at + 1]) in runs), default=0)

    lengths = [longest(k) for k in range(len(words))]
    return [(k, n) for k, n in enumerate(lengths) if n > 1 and (k + 1 == len(words) or lengths[k + 1] != n + 1)]


def test_matches_and_all_their_places_are_those_of_a_plain_search(monkeypatch):
    automaton = LicenseAutomaton({"x y": "p"}, TEMPLATES)
    split = [words_of(t.encode()) for _, t in TEMPLATES]
    seen = []
    monkeypatch.setattr(LicenseAutomaton, "_chains", lambda self, matches, *_: seen.append(matches) or [])
    rng = random.Random(6)
    for _ in range(300):
        words = []
        while len(words) < 40:
            t = rng.choice(split)
            a = rng.randrange(len(t))
            words += t[a : a + rng.randint(1, 6)] + [rng.choice([b"zz", b"a", b"p", b"x"])] * rng.randint(0, 2)
        automaton.scan(words)
        found = seen.pop()
        assert [(at, run) for at, run, _ in found] == plain_matches([*split, [b"x", b"y"]], words)
        for at, run, state in found:
            for number, t in enumerate(split):
                places = {k for k in range(len(t)) if k + 1 >= run and t[k - run + 1 : k + 1] == words[at - run + 1 : at + 1]}
                assert automaton.ends[state].get(number, set()) == places


def notices(words, label, template):
    return [s for s in standard_automaton().scan(words).spans if s.label == label and s.template == template]


def test_every_notice_of_a_text_is_a_span():
    rng = random.Random(9)
    automaton = standard_automaton()
    for number, (template, label) in enumerate(automaton.templates):
        words, want = [], []
        for _ in range(4):
            words += [rng.choice([b"zebra", b"quartz", b"the", b"of"]) + b"%d" % rng.randrange(9) for _ in range(rng.choice([0, 3, 90, 400]))]
            want.append((len(words), len(words) + len(template) - 1))
            words += template
        got = [(s.first_word, s.last_word) for s in notices(words, label, number)]
        assert got == want
        assert all(s.covered == len(template) for s in notices(words, label, number))


def test_parts_far_apart_are_no_notice():
    number, (template, label) = max(enumerate(standard_automaton().templates), key=lambda t: len(t[1][0]))
    half = len(template) // 2
    near = template[:half] + [b"zebra"] * 10 + template[half:]
    far = template[:half] + [b"zebra"] * 500 + template[half:]
    assert len(notices(near, label, number)) == 1
    assert not notices(far, label, number)


def test_a_word_of_the_text_is_covered_once():
    """A run that stands twice in its template does not chain with itself."""
    automaton = LicenseAutomaton({}, [("t", "a b c x a b c y a b c")])
    (span,) = automaton.scan(words_of(b"z a b c z"), shortest=3, covered=0.2).spans
    assert span.covered == 3


def test_two_notices_two_hundred_words_apart():
    text = "Released under the MIT License. " + "word " * 200 + "Released under the MIT License."
    found = standard_automaton().scan(words_of(text.encode()))
    assert len(found.places) == 2
    assert [s for s in found.spans if s.template == 0] == [Span("mit", 0, 0, 4, 5), Span("mit", 0, 205, 209, 5)]


def test_chains_of_a_large_text_stay_few(spark):
    text = " ".join(["Released under the MIT License."] * 3000)
    (row,) = license_scan.scan_licenses(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert row["n_base"] == 3000 and sum(s["template"] == 0 for s in row["spans"]) == 3000
