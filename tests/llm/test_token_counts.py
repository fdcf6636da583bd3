from __future__ import annotations

import json
import random

import public_tokenizers
import pytest
from aqarlens.llm import token_counts as tc
from aqarlens.llm.token_counts import provable, token_counts
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from conftest import prose

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def known():
    return Tokenizer.from_file(PATH)


def expected(rows, known, limit=1024):
    out = []
    for r in rows:
        n = len(known.encode(r.text or "", add_special_tokens=False))
        out.append((r.doc_id, len((r.text or "").encode()), n, n > limit))
    return sorted(out, key=str)


def test_documents(docs, known):
    got = sorted(map(tuple, token_counts(docs, PATH).collect()), key=str)
    assert got == expected(docs.collect(), known)


def hard_texts() -> list[str]:
    """Texts whose chunk ends fall into contractions, spaces, special strings, many-byte letters and long runs."""
    rng = random.Random(5)
    parts = ["<|endoftext|>", "  ", "\n\n \t", "I'll we're it's", "'re", "é漢字", "\U0001f600", "don't", "x" * 40, "123456", " ...", "<|end", "oftext|>", "   <|endoftext|>   "]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(20, 200))) for _ in range(60)]
    texts += ["a" * 5000, " " * 3000 + "b", "word " * 900, "<|endoftext|>" * 300, "\n" * 2000, "ab" * 700 + " " + "c" * 900]
    return [*texts, texts[0], prose(11, 500), "é" * 900]


@pytest.mark.parametrize(("step", "overlap"), [(50, 20), (64, 40), (301, 33)])
def test_chunks_match_whole_texts(spark, known, step, overlap):
    rows = [(k, t) for k, t in enumerate(hard_texts())]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted(map(tuple, token_counts(frame, PATH, limit=100, step=step, overlap=overlap, widen=4).collect()), key=str)
    assert got == expected(frame.collect(), known, 100)


def test_segments_add_up(known, monkeypatch):
    monkeypatch.setattr(tc, "MEMO", 300)
    monkeypatch.setattr(tc, "JOINED", 5)
    counts = tc.SegmentCounts(known)
    mixed = st.lists(st.sampled_from([" ", "  ", "\t", "\n", "\r", "\x1c", "\x85", "\xa0", "\u2003", "'", "re", "<|endoftext|>", "<|", "a", "9", ".", "é"]))

    @settings(max_examples=300, deadline=None)
    @given(st.lists(mixed.map("".join) | st.text(max_size=40), max_size=6))
    def check(texts):
        assert counts(texts) == [len(known.encode(t, add_special_tokens=False)) for t in texts]

    check()


def test_one_joint_needs_wider_overlaps(spark, known):
    """A run without any beginning inside the overlap is cut again, not guessed."""
    text = "alpha " * 20 + "z" * 400 + " omega" * 20
    frame = spark.createDataFrame([(1, text)], "doc_id long, text string")
    (row,) = token_counts(frame, PATH, step=100, overlap=16, widen=2).collect()
    assert row.n_tokens == len(known.encode(text, add_special_tokens=False))


def test_what_is_provable():
    held = json.load(open(PATH))
    assert provable(json.dumps(held)) == 16
    assert provable(json.dumps({**held, "normalizer": {"type": "NFC"}})) is None
    twice = [{**held["added_tokens"][0], "content": c} for c in ("<ab", "b>")]
    assert provable(json.dumps({**held, "added_tokens": twice})) is None
    assert provable(json.dumps({**held, "added_tokens": []})) == 4


def test_other_files_are_encoded_whole(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    frame = spark.createDataFrame([(1, "Some words, " * 60), (2, None)], "doc_id long, text string")
    got = {r.doc_id: r.n_tokens for r in token_counts(frame, path, step=50, overlap=10).collect()}
    assert got == {1: len(library.encode("Some words, " * 60, add_special_tokens=False)), 2: 0}


def test_empty(no_docs):
    assert token_counts(no_docs, PATH).count() == 0
