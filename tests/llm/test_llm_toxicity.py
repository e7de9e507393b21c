"""Toxicity: the automaton against plain edit distances, windows, learning, and held-out accuracy."""

from __future__ import annotations

import math
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from landfall.llm import lexicon, toxicity
from landfall.llm.frames import read_table
from landfall.llm.lexicon import Lexicon, Matcher, edits

SF = "/root/testdata/sf0.1"
TERMS = ["scum", "idiot", "stupid", "worthless", "pathetic", "fou", "réeux", "réeuxan", "idiots"]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, above = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(above[j] + 1, row[-1] + 1, above[j - 1] + (x != y)))
    return row[-1]


def _near(terms, word):
    return sorted((t, distance(t, word)) for t in terms if distance(t, word) <= edits(t))


words = st.one_of(st.text("idotsc ureéx", max_size=9), st.sampled_from(TERMS).flatmap(lambda t: st.integers(0, len(t)).map(lambda i: t[:i] + "x" + t[i + 1 :])))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("abcdé", min_size=1, max_size=8), max_size=12, unique=True), st.lists(st.text("abcdéz", max_size=10), max_size=30))
def test_automaton_finds_what_edit_distance_does(terms, texts):
    matcher = Matcher(Lexicon({t: (0.9, 0.6, 0.4) for t in terms}))
    for word in texts:
        assert sorted(matcher.near(word)) == _near(terms, word)


@settings(max_examples=100, deadline=None)
@given(st.lists(words, max_size=30))
def test_automaton_of_real_terms_started_anew(texts):
    matcher = Matcher(Lexicon({t: (0.9, 0.6, 0.4) for t in TERMS}))
    before, lexicon.STATES = lexicon.STATES, 5
    try:
        for word in texts:
            assert sorted(matcher.near(word)) == _near(TERMS, word)
    finally:
        lexicon.STATES = before


def test_match_prefers_fewer_edits_then_weight_and_leaves_ordinary_words():
    matcher = Matcher(Lexicon({"idiot": (0.9, 0.7, 0.4), "idiom": (0.8, 0.6, 0.4), "moron": (0.9, 0.1, 0.1)}, frozenset(["idiol"]), least=0.3))
    assert matcher.match("idiot").term == "idiot" and matcher.match("idiot").distance == 0
    assert matcher.match("idiox").term == "idiot"  # one edit from both, the heavier one
    assert matcher.match("idiol") is None and matcher.match("moroon") is None and matcher.match("table") is None


def _matcher():
    return Matcher(Lexicon({t: (0.9, 0.6, 0.4) for t in TERMS}, least=0.3))


def test_windows_separate_quotation_from_abuse():
    matcher = _matcher()
    bare = toxicity.text_hits("you are an idiot and worthless", matcher)[1]
    quoted = toxicity.text_hits('the word "idiot" was in the text', matcher)[1]
    reported = toxicity.text_hits("the old man said idiot to the wall", matcher)[1]
    plain = toxicity.text_hits("the old man met idiot by the wall", matcher)[1]
    assert [h.quoted for h in bare + quoted + reported] == [False, False, True, False]
    assert bare[0].score > plain[0].score > reported[0].score
    assert [h.quoted for h in toxicity.text_hits("„idiot“ « scum » “stupid” >\n> idiot\n idiot", matcher)[1]] == [True, True, True, True, False]
    values = dict(zip(toxicity.FEATURES, toxicity.features('they wrote "idiot" here', matcher)))
    assert values["open_mass"] == 0 < values["quoted_mass"]
    prior = np.array(toxicity.PRIOR)
    assert prior @ toxicity.features("you idiot", matcher) > prior @ toxicity.features('he wrote "you idiot"', matcher)


def test_hits_stand_where_they_say():
    matcher, text = _matcher(), "İdiot! An IDIIOT, scüm; wörthless stupid\nworthles."
    n, hits = toxicity.text_hits(text, matcher)
    assert n == len(toxicity.WORD.findall(text))
    assert [(text[h.start : h.end], h.match.term, h.match.distance) for h in hits] == [
        ("İdiot", "idiot", 1), ("IDIIOT", "idiot", 1), ("scüm", "scum", 1), ("wörthless", "worthless", 1), ("stupid", "stupid", 0), ("worthles", "worthless", 1),
    ]


def _learnable(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 != 2


DOCS = "doc_id long, text string, lang string, source string, word string, toxic int, order string, score string"


def _frames(spark, rows):
    docs = spark.createDataFrame([(i, t, "en", "s", "w", 3, "o", "x") for i, t, _ in rows], DOCS)
    known = spark.createDataFrame([(i, y, "o", "w") for i, _, y in rows], "doc_id long, toxic int, order string, word string")
    return docs, known


def _corpus(n=600, seed=1):
    rng = random.Random(seed)
    stock = ["".join(rng.choice("aeioulnrst") for _ in range(rng.randint(2, 9))) for _ in range(400)]
    rows = []
    for i in range(n):
        held, bad = [rng.choice(stock) for _ in range(60)], i % 6 == 0
        if bad:
            for _ in range(3):
                held.insert(rng.randrange(len(held)), rng.choice(["idiot", "worthless", "scumbag"]))
        rows.append((i, " ".join(held), int(bad)))
    return rows


def test_learns_terms_and_catches_misspelt_ones_only_from_learnable_labels(spark):
    rows = _corpus()
    # A word of the held-out fold only must not be learnt, nor one that many copies of one toxic text hold.
    rows = [(i, t + (" blorgword" if y and not _learnable(i) else ""), y) for i, t, y in rows]
    rows += [(1000 + i, "lone uncopied words of one zebrafish text " * 3, 1) for i in range(40)]
    docs, known = _frames(spark, rows)
    learnt = toxicity.learnt_lexicon(docs, known)
    assert set(learnt.weights) == {"idiot", "worthless", "scumbag"}
    clean = " ".join(rows[1][1].split()[:40])
    new = [(5000, clean + " idioot wortless", None), (5001, clean, None), (5002, clean + " idiot", None), (5003, None, None), (5004, "", None)]
    scored = {r.doc_id: r for r in toxicity.toxicity_scores(docs.unionByName(_frames(spark, new)[0]), known).collect()}
    assert [scored[i].predicted for i in (5000, 5001, 5002, 5003, 5004)] == [1, 0, 1, 0, 0]
    assert scored[5003].score == scored[5004].score == scored[5001].score < 0.1
    for i, _, y in rows[:600]:
        assert scored[i].predicted == y and scored[i].held_out != _learnable(i)


def test_spans_of_documents(spark):
    docs, _ = _frames(spark, [(1, "an idiot, “stupid” one", 0), (2, "nothing here", 0), (3, None, 0), (4, "x" * 1_000_000 + " scum", 0)])
    found = toxicity.found_hits(docs, Lexicon({t: (0.9, 0.6, 0.4) for t in TERMS}, least=0.3)).orderBy("doc_id", "start").collect()
    assert [(r.doc_id, r.start, r.stop, r.word, r.quoted) for r in found] == [
        (1, 3, 8, "idiot", False), (1, 11, 17, "stupid", True), (4, 1_000_001, 1_000_005, "scum", False),
    ]


def test_odd_input(spark):
    """Nulls in every column, repeated rows, one label only, no labels, no documents."""
    rows = [(None, "idiot", 1), (1, None, 1), (1, None, 1), (2, "", None), (3, "word " * 100_000, 0), (3, "other", 1)]
    docs, known = _frames(spark, rows)
    found = toxicity.toxicity_scores(docs, known).collect()
    assert len(found) == len(rows) and all(0 < r.score < 1 for r in found)
    none = toxicity.toxicity_scores(docs, known.filter("false")).collect()
    assert {round(r.score, 6) for r in none} == {0.1} and {r.predicted for r in none} == {0}
    assert toxicity.toxicity_scores(docs.filter("false"), known).collect() == []


@pytest.mark.parametrize("n", [0, 3, 400])
def test_fit_is_the_optimum(n):
    """Newton's result has no slope, by differences."""
    rng = np.random.default_rng(n)
    rows = np.abs(rng.normal(size=(n, len(toxicity.FEATURES))))
    labels = (rng.random(n) < 0.3).astype(float)
    share = (labels.sum() + 1) / (n + 10)
    prior = np.array([*toxicity.PRIOR, math.log(share / (1 - share))])

    def loss(w):
        margin = np.column_stack([rows, np.ones(n)]) @ w
        return (np.logaddexp(0, margin) - labels * margin).sum() + toxicity.PRIOR_ROWS * ((w - prior) ** 2).sum() / 2

    best = toxicity.fitted(rows, labels)
    for i in range(len(best)):
        step = np.eye(len(best))[i] * 1e-4
        assert abs(loss(best + step) - loss(best - step)) / 2e-4 < 1e-3


def test_held_out_accuracy(spark):
    docs, labels = read_table(spark, SF, "documents"), read_table(spark, SF, "labels")
    rows = toxicity.toxicity_scores(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    assert np.mean([r.predicted == r.toxic for r in rows]) > 0.98
    assert np.mean([r.predicted for r in rows if r.toxic == 0]) < 0.01
    assert np.mean([r.predicted for r in rows if r.toxic == 1]) > 0.9
