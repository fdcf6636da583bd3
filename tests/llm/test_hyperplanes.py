from __future__ import annotations

import numpy as np
import pytest
from aqarlens.llm.hyperplanes import BUCKET, bits_for, hyperplanes, near_duplicates, tables_for

from brute import component_of


def _rows():
    rng = np.random.default_rng(3)
    rows, k = [], 0
    for _ in range(40):
        centre = rng.standard_normal(16)
        for _ in range(rng.integers(1, 8)):
            rows.append((k := k + 1, (centre + 0.2 * rng.standard_normal(16)).astype(np.float32).tolist()))
    rows += [(k := k + 1, rows[0][1]) for _ in range(30)]
    rows += [(k := k + 1, [2 * x for x in rows[0][1]])]
    odd = [None, [0.0] * 16, [float("nan")] + [1.0] * 15, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15, [], [1.0, 2.0], [2.0, 4.0]]
    return rows + [(k := k + 1, v) for v in odd]


@pytest.mark.parametrize("block", [3, 1000])
def test_matches_all_pairs(spark, block):
    rows = _rows()
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS id", "2 AS vector", "3 AS label")
    got = {r.vec_id: r for r in near_duplicates(frame.repartition(5), block=block).collect()}
    unit = {}
    for k, v in rows:
        if v and None not in v and np.isfinite(v).all() and np.any(v):
            unit[k] = np.array(v, float) / np.linalg.norm(v)
    pairs = [(a, b) for a in unit for b in unit if a < b and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.9]
    parts = component_of([k for k, _ in rows], pairs)
    count = {k: sum(k in p for p in pairs) for k, _ in rows}
    found = sum(got[k].n_links for k, _ in rows)
    assert len(got) == len(rows)
    assert all(got[k].n_links <= count[k] for k in got)
    assert found >= 0.95 * sum(count.values())
    assert all(r.kept == (r.component_id == k) for k, r in got.items())
    assert sum(got[k].component_id != parts[k] for k in got) <= 2


def test_null_ids_and_empty(spark):
    schema = "vec_id long, embedding array<float>"
    frame = spark.createDataFrame([(None, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0])], schema)
    got = sorted(map(tuple, near_duplicates(frame).collect()), key=str)
    assert got == [(1, 1, 1, True), (1, 1, 1, True), (None, 0, None, True)]
    assert near_duplicates(spark.createDataFrame([], schema)).count() == 0


def test_bits_and_tables_grow_with_the_rows():
    """Buckets stay bounded, the chance of a shared bucket stays above 0.98, and both at every size."""
    for rows in (0, 1, 10**4, 10**6, 10**8, 10**11):
        bits = bits_for(rows)
        assert rows / 2**bits <= BUCKET or bits == 30
        alike = (1 - np.arccos(0.9) / np.pi) ** bits
        assert 1 - (1 - alike) ** tables_for(bits, 0.9) >= 0.98
    assert (bits_for(51_282), tables_for(12, 0.9)) == (12, 24)
    assert tables_for(12, 1.0) == 1


@pytest.mark.parametrize("bits", [12, 16, 20])
def test_recall_of_keys_at_the_threshold(bits):
    """Pairs of cosine 0.9 exactly: the share with an equal signature in some table."""
    rng, tables = np.random.default_rng(bits), tables_for(bits, 0.9)
    a, c = (x / np.linalg.norm(x, axis=1, keepdims=True) for x in rng.standard_normal((2, 1_000, 64)))
    c -= (a * c).sum(1, keepdims=True) * a
    b = 0.9 * a + np.sqrt(1 - 0.81) * c / np.linalg.norm(c, axis=1, keepdims=True)
    planes = hyperplanes(64, tables, bits)
    same = ((a @ planes > 0) == (b @ planes > 0)).reshape(-1, tables, bits).all(2).any(1)
    assert same.mean() >= 0.95


def test_more_bits_link_alike(spark):
    rows = [r for r in _rows() if r[1] and None not in r[1] and len(r[1]) == 16 and np.isfinite(r[1]).all() and np.any(r[1])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    few, many = ({r.vec_id: r.component_id for r in near_duplicates(frame, bits=b).collect()} for b in (12, 18))
    assert sum(few[k] != many[k] for k in few) <= 2
