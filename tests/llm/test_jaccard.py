from __future__ import annotations

from itertools import combinations

from aqarlens.llm.jaccard import drop_near_duplicates, near_duplicates

from brute import component_of, shingle_set
from conftest import SCHEMA, prose


def _want(rows):
    sets = {k: shingle_set(t) for k, t in rows}
    edges = [
        (a, b) for a, b in combinations(sets, 2) if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    parts = component_of(sets, edges)
    return {k: (len(sets[k]), parts[k]) for k in sets}


def test_edge_rows(docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = _want([r for r in rows if r[0] is not None])
    got = near_duplicates(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id], r


def test_chains_and_shared_passages(spark):
    """Near copies of near copies, families that share long passages, and a hot family."""
    rows, k = [], 0
    for family in range(6):
        words = prose(family, 90).split()
        for step in range(12):
            words = list(words)
            words[(step * 7) % 90] = f"edit{family}x{step}"
            rows.append((k := k + 1, " ".join(words), "en", "a"))
    passage = prose(99, 70)
    rows += [(k := k + 1, prose(200 + i, 5 + i) + " " + passage, "en", "b") for i in range(40)]
    rows += [(k := k + 1, passage + f" tail{i}", "en", "hot") for i in range(60)]
    want = _want([(r[0], r[1]) for r in rows])
    for partitions in (2, 9):
        got = near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(partitions)).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert len({c for _, c in want.values()}) > 5


def test_one_of_each_component_stays(docs):
    left = drop_near_duplicates(docs.where("doc_id IS NOT NULL"))
    assert left.columns == docs.columns
    ids = {r.doc_id for r in left.collect()}
    assert {1, 5, 6, 7, 8, 10, 11, 12, 13, 14, 15} == ids


def test_empty(no_docs):
    assert near_duplicates(no_docs).count() == 0
