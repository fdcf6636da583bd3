from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from aqarlens.llm import exchange, repeats
from aqarlens.llm.common import chunk_count
from aqarlens.llm.exchange import distinct_texts
from aqarlens.llm.repeats import distinct_rows, repeated_masks, repeated_spans, sorted_contexts, without_repeats
from aqarlens.llm.suffix_groups import suffix_array
from hypothesis import given, settings
from hypothesis import strategies as st

from brute import removed
from conftest import SCHEMA, prose


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=40) | st.lists(st.integers(0, 10**6), max_size=40))
def test_suffix_array(symbols):
    assert suffix_array(symbols) == sorted(range(len(symbols)), key=lambda i: symbols[i:])


def _rows(seed: int = 3, n: int = 120, width: int = 40):
    """Rows of few symbols, half of them with one of eight beginnings, in no order; some twice."""
    rng = np.random.default_rng(seed)
    rows = rng.integers(97, 99, (n, width), dtype=np.uint8)
    rows[: n // 2, : width - 6] = rows[rng.integers(0, 8, n // 2) + n // 2, : width - 6]
    rows[n // 4 : n // 3] = rows[n // 2 : n // 2 + n // 3 - n // 4]
    return rows


def test_contexts_are_ordered_by_the_suffix_array():
    rows = _rows()
    one, place = distinct_rows(rows)
    assert (rows[one][place] == rows).all() and len(one) == len({r.tobytes() for r in rows})
    order, common = sorted_contexts(rows[one])
    inorder = [rows[one][k].tobytes() for k in order]
    assert inorder == sorted(r.tobytes() for r in rows[one]) and list(order) != list(range(len(one)))
    shared = [next(i for i in range(41) if i == 40 or a[i] != b[i]) for a, b in zip(inorder, inorder[1:], strict=False)]
    assert list(common[1:]) == shared


def _contexts(length: int = 24):
    """Contexts of one key: equal windows at several distances before and after their anchors."""
    rows = _rows(width=length + length // 2)
    ctx = np.zeros(len(rows), repeats.context_type(length))
    ctx["text"], ctx["n"], ctx["left"] = rows, 1, length // 2
    ctx["ctx"] = np.arange(len(rows))
    return np.zeros(len(rows), np.uint64), ctx


def test_masks_follow_from_the_suffix_array(monkeypatch):
    """Windows that occur twice by plain comparison; without the suffix array's order they are not found."""
    keys, ctx = _contexts()
    text = [t.tobytes() for t in ctx["text"]]
    # The key holds the bytes after an anchor, so windows are compared at equal distances from it.
    windows = [[(d, t[12 - d : 36 - d]) for d in range(13)] for t in text]
    seen = Counter(w for row in windows for w in row)
    want = [[seen[w] > 1 for w in row] for row in windows]
    assert repeated_masks(keys, ctx, 24).tolist() == want
    monkeypatch.setattr(repeats, "suffix_array", lambda symbols: list(range(len(symbols))))
    assert repeated_masks(keys, ctx, 24).tolist() != want


def _digest(row):
    size = sum(s.end - s.start for s in row.spans)
    return row.n_bytes, size, len(row.spans), hashlib.sha256(bytes(row.kept)).hexdigest()


def test_edge_rows(docs):
    rows = docs.collect()
    want = sorted((str(r.doc_id), d) for r, d in zip(rows, removed([r.text for r in rows], 200), strict=True))
    got = sorted((str(r.doc_id), _digest(r)) for r in without_repeats(docs).collect())
    assert got == want


@pytest.mark.parametrize("hot", [1, 4, 10**9])
def test_both_ways_for_hot_keys(spark, hot):
    """Shared passages at all offsets, with every key hot, some, and none."""
    rng, passage = random.Random(5), prose(50, 90)
    texts = [prose(60 + i, 60) for i in range(8)]
    for i in range(40):
        low = rng.randrange(0, 300)
        texts.append(prose(100 + i, rng.randrange(0, 30)) + passage[low : low + rng.randrange(150, 400)] + prose(200 + i, 9))
    texts += ["ab" * 400, "ba" * 150 + "c", "\0" * 450, "\0" * 210 + "x", passage]
    rows = [(k, t, "en", "a") for k, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    _, dealt, chosen = distinct_texts(frame, "doc_id", "text", 5)
    got = {r.id: _digest(r) for r in repeated_spans(dealt, chosen, 5, 200, hot).collect()}
    assert got == dict(enumerate(removed(texts, 200)))


def test_other_lengths(spark):
    texts = [prose(i % 3, 12)[i : i + 60] for i in range(20)]
    frame = spark.createDataFrame([(k, t, "en", "a") for k, t in enumerate(texts)], SCHEMA)
    got = {r.doc_id: _digest(r) for r in without_repeats(frame, length=24).collect()}
    assert got == dict(enumerate(removed(texts, 24)))


def test_empty(no_docs):
    assert without_repeats(no_docs).count() == 0


def test_keys_shorten_with_the_input():
    assert exchange.key_bytes(10**9) == 6 and exchange.key_bytes(10**14) == 8 and chunk_count(0) == 8
