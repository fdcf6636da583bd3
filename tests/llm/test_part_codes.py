from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest
from aqarlens.llm.part_codes import distinct_sorted, nearest, part_codes

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, parts, entries, rounds, scale=1024):
    """Every part against every entry, in Python integers."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    size = len(kept[0][1]) // parts
    cut = [[tuple(math.floor(scale * float(np.float32(x))) for x in v[p * size : (p + 1) * size]) for p in range(parts)] for _, v, _ in kept]
    books = [[cut[i][p] for i in range(min(entries, len(cut)))] for p in range(parts)]

    def assign():
        out = []
        for row in cut:
            out.append([min((sum((a - b) ** 2 for a, b in zip(part, e, strict=True)), k) for k, e in enumerate(books[p])) for p, part in enumerate(row)])
        return out

    for _ in range(rounds):
        near = assign()
        for p in range(parts):
            for e in range(len(books[p])):
                own = [cut[i][p] for i in range(len(cut)) if near[i][p][1] == e]
                if own:
                    books[p][e] = tuple(sum(x) // len(own) for x in zip(*own, strict=True))
    near = assign()
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    errors = [sum(d for d, _ in n) for n in near]
    return [
        (r[0], "".join(f"{k:02x}" for _, k in n), err, sum(e for e, other in zip(errors, kept, strict=True) if other[2] == r[2]), digest)
        for r, n, err in zip(kept, near, errors, strict=True)
    ]


def sample(n, width, seed, grain=0.25):
    """Coarse components, so that parts share prefixes, repeat and tie."""
    rng = random.Random(seed)
    rows = [(k, [rng.randrange(-6, 7) * grain for _ in range(width)], rng.choice([None, 1, 2, 3])) for k in range(n)]
    rows += [(n + k, rows[0][1], 1) for k in range(n // 3)]
    rows += [(3, rows[3][1], rows[3][2]), (None, rows[5][1], None), (2 * n, None, 1)]
    return rows + [(2 * n + 1, [None] * width, 1), (2 * n + 2, [float("nan")] * width, 2), (2 * n + 3, [float("inf")] * width, None)]


@pytest.mark.parametrize(("n", "width", "parts", "entries"), [(120, 8, 4, 16), (60, 12, 2, 256), (90, 3, 3, 5)])
def test_matches_plain_version(spark, n, width, parts, entries):
    rows = sample(n, width, n)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5).selectExpr("*", "1 AS id", "2 AS vector", "3 AS code", "4 AS same")
    got = [tuple(r) for r in part_codes(frame, parts=parts, entries=entries, rounds=3).collect()]
    assert sorted(got, key=str) == sorted(plain(rows, parts, entries, 3), key=str)


@pytest.mark.parametrize("size", [1, 10, 1 << 23])
def test_walk_finds_the_nearest_entry(size):
    rng = np.random.default_rng(size)
    parts, place = distinct_sorted(rng.integers(-size, size + 1, (700, 5)))
    entries = rng.integers(-size, size + 1, (40, 5))
    entries[7] = entries[3]
    index, distance = nearest(parts, entries)
    far = ((parts[:, None].astype(object) - entries[None].astype(object)) ** 2).sum(2)
    assert (index == far.argmin(1)).all() and (distance == far.min(1)).all()
    assert (index != 7).all() and place.max() == len(parts) - 1


def test_odd_lengths_and_empty(spark):
    rows = [(1, [1.0, 2.0], 1), (2, [0.5, 0.5], 1), (3, [1.0, 2.0, 3.0], 1), (4, [], None)]
    got = {r.vec_id: (r.code, r.error, r.label_error) for r in part_codes(spark.createDataFrame(rows, SCHEMA), parts=2).collect()}
    assert got == {1: ("0000", 0, 0), 2: ("0101", 0, 0), 3: (None, None, 0), 4: (None, None, None)}
    assert part_codes(spark.createDataFrame([], SCHEMA)).count() == 0
    assert part_codes(spark.createDataFrame([(1, None, 1)], SCHEMA)).count() == 0
    with pytest.raises(ValueError, match="equal parts"):
        part_codes(spark.createDataFrame([(1, [1.0, 2.0, 3.0], 1)], SCHEMA), parts=2)
