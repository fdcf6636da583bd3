from __future__ import annotations

import random
import zlib

import numpy as np
from aqarlens.llm.toxicity import FuzzyTrie, _longest, _ordinary, fit_logistic, learn_lexicon, quoted, score_toxicity, without_toxic
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import SCHEMA, prose


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


TERMS = {"abcab": True, "abc": True, "bcaab": True, "cabb": False, "bbbbbb": False}
TRIE = FuzzyTrie(TERMS)


@settings(max_examples=800, deadline=None)
@given(st.text("abc", max_size=9))
def test_automaton_matches_edit_distance(word):
    want = 0
    if any(word.startswith(t) for t in TERMS):
        want = 2
    elif any(whole and len(t) >= 5 and _distance(word, t) <= 1 for t, whole in TERMS.items()):
        want = 1
    assert TRIE.match(word) == want


def test_quotation():
    assert quoted('he said "you fool" today'.split(), 3)
    assert quoted("they called him fool once".split(), 3)
    assert not quoted("what a fool you are".split(), 2)


def test_logistic_separates():
    x = np.array([[0.0], [0.1], [2.0], [2.1]])
    w = fit_logistic(x, np.array([0, 0, 1, 1.0]))
    assert x[0] @ w[:1] + w[1] < 0 < x[2] @ w[:1] + w[1]


def _corpus(spark):
    rng, rows, marks = random.Random(8), [], []
    for k in range(600):
        words, toxic = prose(k, 40).split(), int(k % 5 == 1)
        if toxic:
            words[rng.randrange(40)] = rng.choice(["horrible", "nastyfool", "vermin", "krasst" + rng.choice("abcde")])
            words[rng.randrange(40)] = rng.choice(["horrible", "nastyfool", "vermin"])
        if k == 577:  # outside the labels: misspelt only
            words[3] = "horible"
        rows.append((k, " ".join(words), "en", "a"))
        if k != 577:
            marks.append((k, toxic))
    rows += [(900, None, None, None), (901, "", "en", "a"), (None, "vermin horrible", "en", "a"), (902, "vermin " * 20_000, "en", "a")]
    marks += [(900, None), (None, 1), (3, 0), (3, 0)]
    labels = spark.createDataFrame(marks, "doc_id long, toxic int").selectExpr("*", "1 AS id", "2 AS h", "0 AS quality")
    return spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS id", "2 AS score", "0 AS toxic"), labels


def test_held_out_rows_and_misspelling(spark):
    docs, labels = _corpus(spark)
    got = score_toxicity(docs.repartition(5), labels).collect()
    assert len(got) == docs.count()
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        if r.doc_id is not None and r.doc_id < 600 and r.doc_id != 577:
            assert r.predicted == int(r.doc_id % 5 == 1), r
    by = {r.doc_id: r for r in got}
    assert by[900].predicted == by[901].predicted == 0 and by[902].predicted == by[None].predicted == 1
    assert by[575].score < by[577].score < by[576].score  # clean, one misspelt word, toxic


def test_filter_keeps_clean_rows(spark):
    docs, labels = _corpus(spark)
    left = without_toxic(docs, labels)
    assert left.columns == docs.columns
    ids = {r.doc_id for r in left.collect()}
    assert {k for k in range(600) if k % 5 != 1 and k != 577} | {900, 901} <= ids
    assert not ids & {k for k in range(600) if k % 5 == 1 and k != 577}


def test_empty_tables(spark, no_docs):
    docs, labels = _corpus(spark)
    assert score_toxicity(no_docs, labels).count() == 0
    assert {r.score for r in score_toxicity(docs.limit(5), labels.limit(0)).collect()} == {0.0}


def test_rare_terms_among_many_candidates(spark):
    """30,000 commoner beginnings and words of both kinds of rows do not crowd out a term of a few toxic rows."""
    rng = random.Random(4)
    common = ["".join(rng.choice("abcdefghijklm") for _ in range(9)) for _ in range(6_000)]
    rows = []
    for k in range(400):
        toxic = int(k % 4 == 0)
        words = rng.sample(common, 1_500)
        if toxic and k < 60:
            words[rng.randrange(1_500)] = "zyxwvut"
        rows.append((" ".join(words), toxic, k))
    train = spark.createDataFrame(rows, "text string, toxic int, h long").repartition(4)
    assert learn_lexicon(train) == {"zyxwvut": True}


def test_terms_do_not_depend_on_the_rows_fitted(spark):
    """A term in a 40th of the toxic rows is learned, and its rows score, however few rows the regression is fitted on."""
    rows = [(k, prose(k, 30) + (" rarelyvile" if k % 160 == 1 else " muchviler" if k % 4 == 1 else "")) for k in range(3_200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(k, int(k % 4 == 1)) for k, _ in rows], "doc_id long, toxic int")
    got = {r.doc_id: r.predicted for r in score_toxicity(docs, labels, fit_rows=100).collect()}
    assert all(got[k] == int(k % 4 == 1) for k, _ in rows)


def test_near_copies_are_one_family(spark):
    """Words of one toxic text with 30 near copies are no terms, nor is what copies of one text hold."""
    base = prose(5, 60) + " onlycopied " + prose(6, 60)
    rows = [(base.replace("alpha", f"alpha{k}", 1), 1, k) for k in range(30)] + [(base, 1, 40 + k) for k in range(30)]
    rows += [(f"{prose(100 + k, 40)} widespread {prose(300 + k, 40)}", 1, 100 + k) for k in range(30)]
    rows += [(prose(600 + k, 80), 0, 200 + k) for k in range(90)]
    train = spark.createDataFrame(rows, "text string, toxic int, h long").repartition(3)
    assert learn_lexicon(train) == {"widespread": True}


def test_long_words_are_terms_as_wholes(spark):
    """A compound of 28 letters is a term, and misspelt it is matched."""
    word = "widerwaertigkeitsbeschimpfer"
    rows = [(f"{prose(k, 30)} {word} {prose(300 + k, 30)}", 1, k) for k in range(30)]
    rows += [(prose(600 + k, 60), 0, 100 + k) for k in range(60)]
    train = spark.createDataFrame(rows, "text string, toxic int, h long").repartition(3)
    terms = learn_lexicon(train)
    assert terms == {word: True}
    assert FuzzyTrie(terms).match(word.replace("keits", "keit")) == 1


@settings(max_examples=25, deadline=None)
@given(st.dictionaries(st.text("ab", min_size=4, max_size=20), st.integers(1, 60), min_size=1, max_size=30))
def test_longest_term_of_equal_reach(spark, reach):
    want = set()
    cuts = {t: {t, *(t[:k] for k in range(4, min(len(t), 16) + 1))} for t in reach}
    root = {t: min((c for c in cuts[t] if c in reach), key=len) for t in reach}
    for first in set(root.values()):
        want.add(max((t for t in reach if root[t] == first and reach[t] >= 0.95 * reach[first]), key=lambda t: (len(t), t)))
    table = spark.createDataFrame([(t, True, n) for t, n in reach.items()], "term string, mostly boolean, n long")
    assert {r.term for r in _longest(table).collect()} == want


def test_one_clean_row_does_not_exempt_a_misspelt_form(spark):
    """Of two misspelt forms in one clean row each, the one that toxic rows use 19 times stays a match."""
    words = ["horible"] * 19 + ["horrble"]
    rows = [(f"{prose(k, 20)} {w} {prose(99 + k, 20)}", 1, k) for k, w in enumerate(words)]
    rows += [(f"{prose(900 + k, 20)} {w}", 0, 100 + k) for k, w in enumerate(["horible", "horrble", "horriblo", "fine", "fine"])]
    train = spark.createDataFrame(rows, "text string, toxic int, h long").repartition(3)
    model = spark.sparkContext.broadcast({"horrible": True})
    assert _ordinary(train, model) == {"horrble", "horriblo"}
