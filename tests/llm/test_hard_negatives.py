from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pytest
from aqarlens.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, step, scale=256, positives=5, negatives=3, share=(50, 95)):
    """Every anchor against every row, in Python integers."""
    kept = {}
    for id_, v, label in rows:
        if id_ is None or label is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        one = (label, [math.floor(scale * float(np.float32(x))) for x in v])
        kept[id_] = min(kept.get(id_, one), one)
    out = []
    for a, (label, v) in kept.items():
        if a % step:
            continue
        scores = [(-sum(x * y for x, y in zip(v, w, strict=True)), b, other) for b, (other, w) in kept.items() if b != a and len(w) == len(v)]
        scores.sort()
        for p, id_, other in [s for s in scores if s[2] == label][:positives]:
            inside = [(n, b) for n, b, other in scores if other != label and share[0] * -p <= 100 * -n <= share[1] * -p]
            out += [(a, id_, rank, b, -p, -n) for rank, (n, b) in enumerate(inside[:negatives], 1)]
    return sorted(out)


def sample(n, width, seed):
    """Clusters with near copies, equal vectors, coarse components that tie, and a hot label."""
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((6, width))
    rows = []
    for k in range(n):
        v = centres[rng.integers(6)] + 0.4 * rng.standard_normal(width)
        rows.append((k, np.round(v / np.linalg.norm(v), 2).astype(np.float32).tolist(), int(min(3, rng.integers(6)))))
    rows += [(n + k, rows[10][1], k % 4) for k in range(n // 4)]
    rows += [(2 * n, [0.0] * width, 1), (2 * n + 10, rows[0][1][:2], 1), (2 * n + 11, rows[1][1][:2], 2), (20, rows[20][1], rows[20][2])]
    odd = [(None, rows[0][1], 1), (3 * n, None, 1), (3 * n + 10, rows[0][1], None), (3 * n + 20, [], 1)]
    return rows + odd + [(3 * n + 30, [None] * width, 1), (3 * n + 40, [float("nan")] * width, 1), (3 * n + 50, [float("inf")] * width, 2)]


@pytest.mark.parametrize(("n", "width", "blocks"), [(200, 16, (7, 20, 9)), (150, 5, (2048, 32768, 1024))])
def test_matches_plain_version(spark, monkeypatch, n, width, blocks):
    for name, value in zip(("ANCHORS", "ROWS", "LEAST_ROWS"), blocks, strict=True):
        monkeypatch.setattr(hn, name, value)
    rows = sample(n, width, n)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4).selectExpr("*", "1 AS id", "2 AS vector", "3 AS width", "4 AS score")
    got = sorted(tuple(r) for r in hn.hard_negatives(frame, "id % 10 = 0").collect())
    want = plain(rows, 10)
    assert got == want and len(want) > 50


@pytest.mark.parametrize("width", [3, 16, 70])
def test_intervals_hold_and_filter(width):
    rng = np.random.default_rng(width)
    vectors = np.floor(256 * rng.standard_normal((500, width)) / np.sqrt(width))
    vectors[7] = 0
    bits, size, gain, align = hn.codes_of(vectors, 4)
    rows = pa.table(
        {
            "id": np.arange(500), "label": np.zeros(500, np.int64), "vector": pa.array(vectors.tolist(), pa.list_(pa.float64())),
            "bits": pa.array([b.tobytes() for b in bits], pa.binary()), "size": size, "gain": gain, "align": align,
        }
    )
    block = hn.Block(rows, 4)
    for anchor in vectors[:20]:
        exact = vectors @ anchor
        middle, low, high = block.estimate(anchor)
        assert (low <= exact).all() and (exact <= high).all()
        at, scores = hn.top_rows(block, block.ids != 0, anchor, 5)
        want = sorted(((-s, k) for k, s in enumerate(exact.tolist()) if k), key=lambda x: x)[:5]
        assert [(-s, k) for s, k in zip(scores.tolist(), at.tolist(), strict=True)] == want
    # The filter leaves some rows unscored where dimensions are many enough to tell.
    assert width < 16 or (block.estimate(vectors[0])[2] < np.sort(vectors @ vectors[0])[-5]).any()


def test_empty(spark):
    assert hn.hard_negatives(spark.createDataFrame([], SCHEMA)).count() == 0
    assert hn.hard_negatives(spark.createDataFrame([(50, [1.0], 1)], SCHEMA)).count() == 0
