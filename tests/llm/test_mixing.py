from __future__ import annotations

import math

import pytest
from aqarlens.llm.mixing import entropy, fit_exponent, mix_sources, repeat_rows, shares, with_tokens
from pyspark.sql import functions as F

from conftest import SCHEMA, prose

TOKENS = {"big": 9000, "mid": 900, "small": 100}


def test_exponent_meets_its_target():
    top = entropy(shares(TOKENS, 0.0))
    assert top == pytest.approx(math.log(3)) and entropy(shares(TOKENS, 1.0)) < 0.4
    found = fit_exponent(TOKENS, target_entropy=0.8)
    assert entropy(shares(TOKENS, found)) == pytest.approx(0.8, abs=1e-9)
    assert fit_exponent(TOKENS, target_entropy=9.0) == 0.0 and fit_exponent(TOKENS, target_entropy=0.0) == 1.0
    found = fit_exponent(TOKENS, max_repeats=3.0)
    weights = shares(TOKENS, found)
    assert max(10_000 * w / TOKENS[s] for s, w in weights.items()) == pytest.approx(3.0)
    kept = fit_exponent(TOKENS, max_repeats=3.0, keep_all=True)
    weights = shares(TOKENS, kept)
    give = max(TOKENS[s] / w for s, w in weights.items())
    assert max(give * w / TOKENS[s] for s, w in weights.items()) == pytest.approx(3.0)
    assert min(give * w / TOKENS[s] for s, w in weights.items()) == pytest.approx(1.0)
    with pytest.raises(ValueError):
        fit_exponent(TOKENS)


def _corpus(spark):
    rows = [(k, prose(k, 5 + k % 30), "en", "hot" if k % 3 == 0 else f"s{k % 7}") for k in range(900)]
    rows += [(5000, None, None, None), (5001, "", "en", "s1"), (None, "a b c", "en", "s2"), (5002, "x y", "en", None)]
    return spark.createDataFrame(rows, SCHEMA)


def test_budgets_match_brute_force(spark):
    """Copies are whole passes, and the first documents of one more permutation until the budget is met."""
    docs = _corpus(spark).selectExpr("*", "1 AS tokens", "2 AS weight", "3 AS place")
    got = mix_sources(docs.repartition(6), max_repeats=1.5).collect()
    assert len(got) == docs.count()
    known = with_tokens(docs, "doc_id", "text", "source").collect()
    totals = {}
    for r in known:
        totals[r.source] = totals.get(r.source, 0) + r.tokens
    weights = shares(totals, fit_exponent(totals, max_repeats=1.5))
    for source, n in totals.items():
        own = [r for r in got if r.source == source]
        budget = round(sum(totals.values()) * weights[source])
        assert {r.budget for r in own} == {budget} and own[0].weight == pytest.approx(weights[source])
        passes, rest = divmod(budget, n)
        order = docs.sparkSession.createDataFrame(
            [(r.source, r.doc_id, r.tokens) for r in own], "source string, id long, tokens long"
        ).select("id", "tokens", F.xxhash64(F.lit(1), F.lit(passes).cast("long"), "source", "id", "tokens").alias("p"))
        taken, before = {}, 0
        for r in sorted(order.collect(), key=lambda r: r.p % 2**64):
            taken[r.id] = before < rest
            before += r.tokens
        for r in own:
            assert r.copies == (max(passes, 1) if not r.tokens else passes + taken[r.doc_id]), r


def test_partitions_do_not_matter_and_all_are_kept(spark):
    docs = _corpus(spark)
    a = mix_sources(docs.repartition(2), max_repeats=2.0, keep_all=True)
    b = mix_sources(docs.repartition(9), max_repeats=2.0, keep_all=True)
    assert a.exceptAll(b).count() == 0
    assert a.agg(F.min("copies")).first()[0] >= 1 and a.agg(F.max("copies")).first()[0] <= 3
    rows = repeat_rows(docs, a)
    assert rows.columns == docs.columns and rows.count() == a.agg(F.sum("copies")).first()[0]


def test_empty_and_without_tokens(spark, no_docs):
    assert mix_sources(no_docs).count() == 0
    blank = spark.createDataFrame([(1, None, None, "a"), (2, " ", None, None)], SCHEMA)
    assert {r.copies for r in mix_sources(blank).collect()} == {0}


def test_cut_among_repeated_rows(spark):
    """Every row occurs twice, so cuts fall on shared places; rows with a place below the cut are taken, others not."""
    rows = [(k, prose(k, 5 + k % 20), "en", f"s{k % 5}") for k in range(400)] * 2
    docs = spark.createDataFrame(rows, SCHEMA)
    got = mix_sources(docs, max_repeats=1.5).collect()
    assert len(got) == len(rows)
    totals = {}
    for r in got:
        totals[r.source] = totals.get(r.source, 0) + r.tokens
    checked = 0
    for source, n in totals.items():
        own = {r.doc_id: r for r in got if r.source == source}
        passes, rest = divmod(next(iter(own.values())).budget, n)
        order = spark.createDataFrame(
            [(source, k, r.tokens) for k, r in own.items()], "source string, id long, tokens long"
        ).select("id", "tokens", F.xxhash64(F.lit(1), F.lit(passes).cast("long"), "source", "id", "tokens").alias("p"))
        before = 0
        for r in sorted(order.collect(), key=lambda r: r.p % 2**64):
            assert {x.copies for x in got if x.doc_id == r.id} == {passes + (before < rest)}, (source, r)
            before += 2 * r.tokens
        checked += 0 < rest
    assert checked >= 3


def test_jobs_do_not_follow_the_shuffle_partitions(spark, docs):
    """One job per partition and per level, on nothing mostly, took minutes with a few hundred partitions."""
    settings = {"spark.sql.shuffle.partitions": "60", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in settings}
    group = "mixing-jobs"
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        spark.sparkContext.setJobGroup(group, "jobs of one mixture")
        assert mix_sources(docs).count() == docs.count()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        for name, value in before.items():
            spark.conf.set(name, value)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) < 60
