from __future__ import annotations

import hashlib

import corpus_pipeline
import public_tokenizers
import tiktoken
from aqarlens.llm.bpe import read_ranks
from aqarlens.llm.common import components, stage

from conftest import SCHEMA, edge_rows, prose


def _write(spark, folder, rows, marks):
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")


def test_stages_keep_columns_and_clean_rows(spark, tmp_path):
    folder = str(tmp_path)
    rows = edge_rows() + [(1000 + k, f"{prose(700 + k, 12)} vermin {prose(800 + k, 9)}", "en", "t") for k in range(40)]
    rows += [(2000 + k, f"clean sentence {k} about {k * 13} quiet things", "en", "c") for k in range(80)]
    marks = [(r[0], 1, int(r[0] is not None and 1000 <= r[0] < 2000)) for r in rows if r[0] is not None]
    _write(spark, folder, rows, marks)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = {}
    for name, apply in corpus_pipeline.STAGES:
        given = docs
        docs = stage(apply(spark, docs, folder), f"test-{name}")
        seen[name] = docs.collect()
        if name != "bpe":
            assert docs.columns == given.columns
    ids = {name: {r.doc_id for r in out} for name, out in seen.items()}
    assert not any(k is not None and 1000 <= k < 2000 for k in ids["toxicity"])
    assert {2000 + k for k in range(80)} <= ids["toxicity"]
    assert 1 in ids["exact_dedup"] and not {2, 3, 100, 139} & ids["exact_dedup"]
    assert len(seen["exact_dedup"]) == len({(r.doc_id, r.text) for r in seen["exact_dedup"]})
    assert 4 not in ids["ngram_jaccard"] and 9 not in ids["ngram_jaccard"] and {1, 8, 10, 11} <= ids["ngram_jaccard"]
    assert ids["mix_sources"] == ids["ngram_jaccard"] and len(seen["bpe"]) == len(seen["mix_sources"])
    known = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(public_tokenizers.path(corpus_pipeline.VOCABULARY)), special_tokens={}
    )
    text = {r.doc_id: r.text or "" for r in seen["mix_sources"] if r.doc_id is not None}
    for r in seen["bpe"]:
        if r.doc_id is not None:
            assert r.n_tokens == len(known.encode_ordinary(text[r.doc_id]))
            assert r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest()
    assert corpus_pipeline.run(spark, folder).count() == len(seen["bpe"])


def test_columns_of_any_name_pass(spark, tmp_path):
    """Columns named like the stages' own come through every stage with their values."""
    rows = [(k, prose(k, 12), "en", "ab"[k % 2]) for k in range(12)] + [(12, prose(3, 12), "en", "a"), (5, prose(5, 12), "en", "b")]
    rows += [(20 + k, f"{prose(60 + k, 9)} vermin {prose(90 + k, 5)}", "en", "a") for k in range(9)] + [(None, prose(4, 12), "en", "a")]
    names = ["__sha", "__id", "__s", "__k", "__copies", "__ID_", "digest"]
    _write(spark, str(tmp_path), rows, [(k, 1, int(k >= 20)) for k in range(29)])
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", *[f"concat('{n}', doc_id) AS `{n}`" for n in names])
    docs = frame
    for _, apply in corpus_pipeline.STAGES[:-1]:
        docs = apply(spark, docs, str(tmp_path))
    found = docs.collect()
    assert docs.columns == frame.columns and {r.doc_id for r in found} >= set(range(12))
    assert all(r[n] == (None if r.doc_id is None else f"{n}{r.doc_id}") for r in found for n in names)


def test_empty_documents(spark, tmp_path):
    _write(spark, str(tmp_path), [], [(1, 1, 0)])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_components_of_paths_stars_and_loops(spark):
    edges = [(k, k + 1) for k in range(50)] + [(100, k) for k in range(101, 160)] + [(7, 7), (300, 299), (299, 300)]
    frame = spark.createDataFrame(edges, "a long, b long")
    got = {r.id: r.component for r in components(frame).collect()}
    want = {k: 0 for k in range(51)} | {k: 100 for k in range(100, 160)} | {299: 299, 300: 299}
    assert got == want
    assert components(frame.limit(0)).count() == 0
