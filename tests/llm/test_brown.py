from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from aqarlens.llm import brown
from aqarlens.llm.brown import END, exchange_classes, log_probabilities, score_documents, tokens

from brute import words
from conftest import SCHEMA


def _held(k):
    return k is not None and zlib.crc32(str(k).encode()) % 7 == 2


def _base(rows):
    count = Counter()
    for k, text in rows:
        if not _held(k):
            count.update([*words(text), None])
    n, v = sum(count.values()), len(count)
    for k, text in rows:
        t = [*words(text), None]
        yield k, _held(k), len(t), sum(count[x] > 0 for x in t), n, sum(math.log10((count[x] + 1) / (n + v + 1)) for x in t)


def test_counts_and_base_score(docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = score_documents(docs, head=20, classes=5).collect()
    want = sorted(_base(rows), key=str)
    have = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got), key=str)
    assert [h[:5] for h in have] == [w[:5] for w in want]
    np.testing.assert_allclose([h[5] for h in have], [w[5] for w in want], rtol=1e-9)


def _grammar(spark, n=400):
    """Two kinds of words that alternate: classes tell what comes next, words alone do not."""
    rng = random.Random(4)
    rows = []
    for k in range(n):
        text = " ".join(("n" if i % 2 else "v") + str(min(int(rng.expovariate(0.1)), 60)) for i in range(rng.randrange(4, 40)))
        rows.append((k, text, "en", "a"))
    return spark.createDataFrame(rows, SCHEMA)


def test_classes_help_on_held_out_rows(spark):
    got = [r for r in score_documents(_grammar(spark), head=40, classes=2).collect() if r.held_out]
    tokens = sum(r.n_tokens for r in got)
    assert len(got) > 30
    gain = (sum(r.score for r in got) - sum(r.base_score for r in got)) / tokens
    assert gain > 0.2  # close to log10(2), what knowing the kind of the next word is worth


def test_partitions_do_not_matter(spark):
    docs = _grammar(spark, 120)
    a = {r.doc_id: r.score for r in score_documents(docs.repartition(2), head=30, classes=3).collect()}
    b = {r.doc_id: r.score for r in score_documents(docs.repartition(7), head=30, classes=3).collect()}
    assert all(math.isclose(a[k], b[k], rel_tol=1e-12) for k in a)


def _model_scores(rows, head, classes, rounds):
    """log10 probability of each text by plain counting; only the clustering of head words is the operator's."""
    texts = [(k, [int(w) for w in np.concatenate([w for _, _, w, _ in tokens([t])])]) for k, t in rows]
    train = [t for k, t in texts if not _held(k)]
    end, loose, rare, last = int(END), classes, classes + 1, classes + 2
    n = Counter(w for t in train for w in t)
    signed = {w: int(np.uint64(w).astype(np.int64)) for w in n}
    known = sorted([w for w in sorted(n, key=lambda w: (-n[w], signed[w])) if w != end][:head] + [end])
    pairs = np.zeros((len(known), len(known)))
    for t in train:
        for a, b in zip([end, *t], t, strict=False):
            if a in known and b in known:
                pairs[known.index(a), known.index(b)] += 1
    fitted = dict(zip(known, map(int, exchange_classes(pairs, classes, known.index(end))), strict=True))
    both = np.full((classes + 1, classes + 1), 0.5)
    for a, x in fitted.items():
        for b, y in fitted.items():
            both[x, y] += pairs[known.index(a), known.index(b)]
    near = dict(fitted)
    for _ in range(rounds + 1):
        score, seen = {}, Counter()
        for t in train:
            for a, w, b in zip([end, *t], t, [*t[1:], None], strict=False):
                s = score.setdefault(w, np.zeros(classes))
                if a in near:
                    s += [math.log(both[near[a], c] / both[:, c].sum()) for c in range(classes)]
                if b in near:
                    s += [math.log(both[c, near[b]] / both[c].sum()) for c in range(classes)]
                seen[w] += a in near or b in near
        cls = {w: fitted.get(w, int(np.argmax(score[w])) if seen[w] else loose) for w in n}
        near = {w: c for w, c in cls.items() if w == end or (n[w] > 1 and c < loose)}
    cls = {w: cls[w] if n[w] > 1 else rare for w in n} | {end: last}
    states = classes + 3
    one, two, three = Counter(), Counter(), Counter()
    for t in train:
        c = [last, last, *(cls[w] for w in t)]
        for x, y, z in zip(c, c[1:], c[2:], strict=False):
            one[z] += 1
            two[y, z] += 1
            three[x, y, z] += 1
    for k, t in texts:
        c = [last, last, *(cls.get(w, rare) for w in t)]
        total = 0.0
        for w, x, y, z in zip(t, c, c[1:], c[2:], strict=False):
            p = (one[z] + 1) / (sum(one.values()) + states)
            p = (two[y, z] + 12 * p) / (sum(two[y, i] for i in range(states)) + 12)
            p = (three[x, y, z] + 12 * p) / (sum(three[x, y, i] for i in range(states)) + 12)
            total += math.log10(p * (1 / (one[z] + 1) if z == rare else max(n[w], 1) / max(one[z], 1)))
        yield k, total, c


@pytest.mark.parametrize("rounds", [0, 1, 2])
def test_score_of_the_model(spark, monkeypatch, rounds):
    """Scores by plain counting; some words are seen twice, but never beside a placed one."""
    monkeypatch.setattr(brown, "chunk_count", lambda size: 1)
    rng, rows = random.Random(8), []
    for k in range(60):
        words = [("n" if i % 2 else "v") + str(min(int(rng.expovariate(0.15)), 40)) for i in range(rng.randrange(1, 25))]
        rows.append((k, " ".join(words + ["x1 x2 x3 x4 x5"] * (k % 9 == 1)), "en", "a"))
    got = {r.doc_id: r.score for r in score_documents(spark.createDataFrame(rows, SCHEMA), "doc_id", "text", 6, 3, rounds).collect()}
    want = list(_model_scores([r[:2] for r in rows], 6, 3, rounds))
    assert rounds or any(3 in c for *_, c in want)
    assert all(math.isclose(got[k], s, rel_tol=1e-9) for k, s, _ in want) and len(got) == len(want)


def test_every_repeated_word_is_placed_after_the_rounds():
    """A chain of words, of which only the ends stand beside head words, is placed link by link."""
    rows = [(k, "a b " * 9 + "c1 c2 c3 c4 c5 c6 c7", "en", "a") for k in range(12)]
    loose = [sum(3 in c for *_, c in _model_scores([r[:2] for r in rows], 2, 3, n)) for n in (0, 3)]
    assert loose == [12, 0]


def test_exchange_finds_alternating_kinds():
    pairs = np.zeros((9, 9))
    pairs[:4, 4:8] = 5
    pairs[4:8, :4] = 5
    pairs[8, :4] = pairs[4:8, 8] = 1
    classes = exchange_classes(pairs, 2, 8)
    assert len(set(classes[:4])) == 1 and len(set(classes[4:8])) == 1 and classes[0] != classes[4] and classes[8] == 2


def test_transitions_are_probabilities():
    counts = np.random.default_rng(1).integers(0, 5, (4, 4, 4)).astype(float)
    sizes = counts.sum((0, 1))
    sizes[2] += 1
    total = (10 ** log_probabilities(counts) * sizes).sum(2)
    np.testing.assert_allclose(total, 1)


def test_empty_and_untrained(spark, no_docs):
    assert score_documents(no_docs, head=5, classes=2).count() == 0
    held = next(k for k in range(50) if _held(k))
    only = spark.createDataFrame([(held, "a b", None, None)], SCHEMA)
    row = score_documents(only, head=5, classes=2).first()
    assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens, row.base_score) == (True, 3, 0, 0, 0.0)
    assert math.isfinite(row.score)
