from __future__ import annotations

import hashlib

import public_tokenizers
import pytest
import tiktoken
from aqarlens.llm.bpe import Encoder, PerfectHash, decode, encode, read_ranks, token_digests
from hypothesis import given, settings
from hypothesis import strategies as st

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def ranks():
    return read_ranks(PATH)


@pytest.fixture(scope="module")
def encoder(ranks):
    return Encoder(PerfectHash(ranks), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def known(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_perfect_hash_is_minimal(ranks):
    table = PerfectHash(ranks)
    assert len(table.keys) == len(ranks) and None not in table.keys
    assert all(table.get(k) == v for k, v in ranks.items())
    assert table.get(b"no such token in here") is None
    assert PerfectHash({}).get(b"a") is None and PerfectHash({b"a": 3}).get(b"a") == 3


def test_encoder_matches_library(encoder, known):
    @settings(max_examples=300, deadline=None)
    @given(st.text(max_size=80) | st.text("ab \n\té漢<|>'s1", max_size=200))
    def check(text):
        assert encoder.encode(text) == known.encode_ordinary(text)

    check()
    for text in ("a" * 4000, "é" * 1500, " " * 999, "<|endoftext|>", ""):
        assert encoder.encode(text) == known.encode_ordinary(text)


def test_documents(docs, known):
    got = sorted(map(tuple, token_digests(docs, PATH, public_tokenizers.PATTERN).collect()), key=str)
    want = []
    for r in docs.collect():
        ids = known.encode_ordinary(r.text or "")
        listed = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        want.append((r.doc_id, len(ids), listed, hashlib.sha256((r.text or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)


def test_round_trip_and_empty(docs, no_docs):
    ids = encode(docs, PATH, public_tokenizers.PATTERN)
    back = sorted(bytes(r.decoded) for r in decode(ids, PATH).collect())
    assert back == sorted((r.text or "").encode() for r in docs.collect())
    assert token_digests(no_docs, PATH, public_tokenizers.PATTERN).count() == 0
