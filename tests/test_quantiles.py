from __future__ import annotations

import math
import random

import pytest

from aqarlens.operators.quantiles import approx_quantiles, exact_quantiles, exact_quantiles_multi, sketch_quantiles


def brute(values, q):
    clean = sorted(v for v in values if v is not None and not math.isnan(v))
    if not clean:
        return None
    return clean[max(1, math.ceil(len(clean) * q)) - 1]


@pytest.mark.parametrize("seed", [1, 2])
def test_exact_quantiles_match_brute_force_with_hot_value(spark, seed):
    rng = random.Random(seed)
    values = [rng.random() * 1000 for _ in range(3000)] + [42.0] * 1500 + [None] * 50 + [float("nan")] * 5
    rng.shuffle(values)
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(5)
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = exact_quantiles(df, "x", probs, buckets=16)
    assert got == [brute(values, q) for q in probs]


def test_exact_quantiles_multi_columns_and_empty(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (3.0, None), (4.0, None)], "a double, b double")
    found = exact_quantiles_multi(df, {"a": [0.5, 0.99], "b": [0.5]})
    assert found == {"a": [2.0, 4.0], "b": [None]}


def test_approx_quantiles_within_error(spark):
    values = list(range(1, 10_001))
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    low, mid = approx_quantiles(df, "x", [0.1, 0.5], 0.01)
    assert abs(low - 1000) <= 100 and abs(mid - 5000) <= 100


def test_refinement_rounds_keep_results_exact(spark):
    # final_rows far below n forces several narrowing rounds, with a hot value.
    import random as _random

    rng = _random.Random(7)
    values = [rng.random() * 100 for _ in range(4000)] + [13.5] * 3000 + [rng.randint(0, 9) * 1.0 for _ in range(2000)]
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(4)
    probs = [0.001, 0.3, 0.5, 0.77, 0.999]
    assert exact_quantiles(df, "x", probs, buckets=4, final_rows=50) == [brute(values, q) for q in probs]


def test_single_job_path_matches_round_path(spark):
    import random as _random

    rng = _random.Random(3)
    values = [rng.random() for _ in range(3000)] + [0.25] * 1000 + [None] * 10
    df = spark.createDataFrame([(v, None if v is None else v * 2) for v in values], "x double, y double")
    requests = {"x": [0.0, 0.01, 0.5, 0.99, 1.0], "y": [0.3]}
    assert exact_quantiles_multi(df, requests, row_hint=len(values)) == exact_quantiles_multi(df, requests)
    assert exact_quantiles_multi(df, requests, row_hint=len(values))["x"] == [brute(values, q) for q in requests["x"]]
    empty = spark.createDataFrame([], "x double")
    assert exact_quantiles_multi(empty, {"x": [0.5]}, row_hint=0) == {"x": [None]}


def test_sketched_quantiles_of_groups(spark):
    """A hot group, a small one, a null key and a group without numbers; ranks within 0.01."""
    rng = random.Random(4)
    rows = [("hot", rng.gauss(0, 1)) for _ in range(20000)] + [("few", float(k)) for k in range(7)]
    rows += [(None, 5.0), ("none", None), ("none", math.nan), ("few", None)]
    frame = spark.createDataFrame(rows, "g string, x double").repartition(5)
    probs = (0.0, 0.1, 0.5, 0.99, 1.0)
    got = {(r.g, r.probability): r.value for r in sketch_quantiles(frame, "x", probs, ("g",)).collect()}
    assert len(got) == 4 * len(probs)
    for group in ("hot", "few", None):
        values = sorted(x for g, x in rows if g == group and x is not None)
        for p in probs:
            low = sum(v < got[group, p] for v in values)
            high = sum(v <= got[group, p] for v in values)
            slack = 0.01 * len(values) + 1
            assert low - slack <= p * len(values) <= high + slack
    assert {got["none", p] for p in probs} == {None}
    assert [r.value for r in sketch_quantiles(frame.where("g = 'few'"), "x", (0.5,)).collect()] == [3.0]
