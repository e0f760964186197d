"""Toxicity and personal data against plain searches, and on long texts full of matches."""

import math
import random
import time
from collections import Counter

import numpy as np
import pytest

from tripstar.llm import pii, toxicity


def plain_words(folded, weights, exceptions):
    """Every place and every term tried in turn."""
    covered = set()
    for phrase in exceptions:
        at = folded.find(f" {phrase} ")
        while at >= 0:
            covered.update(range(at, at + len(phrase) + 1))
            at = folded.find(f" {phrase} ", at + 1)
    best = {}
    for at in range(len(folded)):
        hits = [w for t, w in weights.items() if w and folded.startswith(t, at)]
        if hits and at not in covered:
            best[at] = max(hits)
    return best


@pytest.mark.parametrize("seed", range(20))
def test_automaton_equals_plain_search(seed):
    rng = random.Random(seed)
    vocabulary = ["ab", "abc", "abcd", "b", "bcd", "ca", "abab"]
    weights = {f" {w}" + rng.choice(["", " "]): rng.choice([0.5, 1.0, 2.0]) for w in rng.sample(vocabulary, 4)}
    exceptions = tuple(" ".join(rng.choices(vocabulary, k=2)) for _ in range(3))
    folded = f" {' '.join(rng.choices(vocabulary, k=200))} "
    assert toxicity.Matcher(weights, exceptions).words(folded) == plain_words(folded, weights, exceptions)


def test_marks_and_invisible_characters():
    assert toxicity.fold("id​iot ídiot mo­ron ïdiot й 한국") == " idiot idiot moron idiot и 한국 "


def test_lexicon_equals_plain_counts(spark, frame):
    rng = random.Random(3)
    common = [f"word{k}" for k in range(30)]
    rows = []
    for i in range(240):
        toxic = i % 3 == 0
        rows.append((i, int(toxic), " ".join(rng.choices(common, k=20) + (["rareinsult"] if toxic and i % 4 == 0 else []) + (["zzz"] if rng.random() < 0.5 else []))))
    train = spark.createDataFrame([(t, toxicity.fold(x)) for _, t, x in rows], "toxic int, folded string")
    n, m = 80, 160
    counts = {k: Counter(t for _, toxic, x in rows if toxic == k for t in toxicity.terms_of(toxicity.fold(x))) for k in (0, 1)}
    wanted = {}
    for term, a in counts[1].items():
        b = counts[0][term]
        if a > 2:
            share = (a + b) / (n + m)
            cells = [(a, n * share), (b, m * share), (n - a, n * (1 - share)), (m - b, m * (1 - share))]
            evidence = 2 * sum(k * math.log(k / e) for k, e in cells if k)
            wanted[term] = (math.log((a + 0.5) / (n - a + 0.5)) - math.log((b + 0.5) / (m - b + 0.5)), evidence)
    got = {r.term: (r.weight, r.evidence) for r in toxicity.weighed_terms(train, n, m).collect()}
    assert got.keys() == wanted.keys()
    np.testing.assert_allclose([got[t] for t in wanted], list(wanted.values()), rtol=1e-9, atol=1e-9)
    labels = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id bigint, toxic int")
    model = toxicity.fit(frame([(i, x) for i, _, x in rows]), labels)
    assert " rareinsult " in model.weights and " zzz " not in model.weights


def test_exceptions_are_a_parameter(spark, frame):
    rows = [(i, "you idiot" if i % 2 else "good day") for i in range(60)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id bigint, toxic int")
    model = toxicity.fit(frame(rows), labels, exceptions=("Useful  Idiot",))
    scored = {r.doc_id: r.score for r in toxicity.score(frame([(1, "a useful idiot"), (2, "an idiot")]), model).collect()}
    assert scored[1] < 0.5 < scored[2]


def test_long_texts_take_linear_time():
    matcher = toxicity.Matcher({" idiot ": 3.0, " trash ": 3.0})
    began = time.monotonic()
    assert len(matcher.words(toxicity.fold("idiot trash can " * 60_000))) == 60_000
    assert len(pii.find("call 555-123-4567 or a.b@c.de " * 30_000)) == 60_000
    assert time.monotonic() - began < 30


def test_added_spans_equal_plain_overlap():
    rng = random.Random(7)
    pieces = ["tel 555-123-4567", "+49 555-123-4567", "ssn 123-45-6789", "4111 1111 1111 1111", "a@b.de", "10.0.0.1", "DE89 3704 0044 0532 0130 00", " ", ","]
    for _ in range(200):
        text = "".join(rng.choices(pieces, k=8))
        scored = []
        for kind, start, end in pii._proposals(text):
            near = text[max(0, start - pii.CONTEXT) : start] + "\n" + text[end : end + pii.CONTEXT]
            if pii.SCORES[kind] + (pii.BONUS if pii._WORDS[kind].search(near) else 0) >= pii.LEAST_SCORE:
                scored.append((start, end, kind))
        base = [s for s in scored if s[2] in pii.BASE]
        wanted = base + [s for s in scored if s[2] not in pii.BASE and not any(s[0] < b[1] and b[0] < s[1] for b in base)]
        assert sorted(s[:3] for s in pii.find(text)) == sorted(wanted)
