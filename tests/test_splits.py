from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from aqarlens.operators.splits import (
    hash_split,
    map_sample,
    random_split,
    segment_sample,
    split_fractions,
    split_frames,
    union_splits,
)


def _ids(spark, n=20_000):
    return spark.range(n).withColumnRenamed("id", "listing_id").withColumn(
        "category", F.when(F.col("listing_id") % 5 == 0, "rent").otherwise("buy")
    )


def test_hash_split_is_disjoint_complete_and_stable(spark):
    df = _ids(spark)
    a = hash_split(df.repartition(3))
    b = hash_split(df.repartition(11))
    assert a.count() == df.count()
    assert a.select("listing_id", "split").exceptAll(b.select("listing_id", "split")).count() == 0
    shares = {r["split"]: r["count"] / 20_000 for r in a.groupBy("split").count().collect()}
    assert shares["train"] == pytest.approx(0.6, abs=0.02)
    assert shares["validation"] == pytest.approx(0.2, abs=0.02)
    assert shares["test"] == pytest.approx(0.2, abs=0.02)


def test_split_frames_and_union_keep_every_row(spark):
    frames = split_frames(hash_split(_ids(spark, 1000)))
    assert sum(f.count() for f in frames.values()) == 1000
    union = union_splits(frames, column="split")
    assert union.count() == 1000 and union.select("listing_id").distinct().count() == 1000


def test_train_share_must_be_positive():
    with pytest.raises(ValueError):
        split_fractions(0.5, 0.5)


def test_null_keys_are_dealt_like_others(spark):
    df = spark.range(6000).selectExpr("CAST(NULL AS LONG) AS listing_id", "id AS x")
    counts = {r["split"]: r["count"] / 6000 for r in hash_split(df).groupBy("split").count().collect()}
    assert counts["train"] == pytest.approx(0.6, abs=0.03) and counts["test"] == pytest.approx(0.2, abs=0.03)


def test_random_split_does_not_depend_on_partitions(spark):
    df = _ids(spark, 5000)
    a, b = random_split(df.repartition(3)), random_split(df.repartition(7))
    assert sum(p.count() for p in a.values()) == 5000
    for name in a:
        assert a[name].exceptAll(b[name]).count() == 0
    assert a["train"].count() == pytest.approx(3000, rel=0.05)
    assert a["train"].exceptAll(random_split(df, seed=7)["train"]).count() > 0


def test_samples_near_their_fractions(spark):
    df = _ids(spark)
    assert map_sample(df, 5000).count() == pytest.approx(5000, rel=0.1)
    assert map_sample(df.repartition(3), 5000).exceptAll(map_sample(df.repartition(7), 5000)).count() == 0
    sample = segment_sample(df)
    counts = {r["category"]: r["count"] for r in sample.groupBy("category").count().collect()}
    assert counts["buy"] == pytest.approx(16_000 * 0.2, rel=0.1)
    assert counts["rent"] == pytest.approx(4_000 * 0.5, rel=0.1)
    assert map_sample(df.limit(0), 10).count() == 0
    capped = segment_sample(df, caps={"buy": F.col("listing_id") < 100, "rent": F.lit(None).cast("boolean")})
    assert {r["category"] for r in capped.collect()} == {"buy"}
    assert capped.agg(F.max("listing_id")).first()[0] < 100
