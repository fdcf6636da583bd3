from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from aqarlens.operators import encoding
from aqarlens.operators.encoding import (
    TargetEncodingModel,
    add_target_encodings,
    apply_target_encoding,
    fit_target_encoding,
)
from aqarlens.operators.joins import broadcast_if_small


def test_unseen_values_get_the_training_mean(spark):
    train = spark.createDataFrame([("k1", 3.0), ("k2", 5.0), ("k2", 7.0), ("k3", 1.0)], "city string, price_per_sqm double")
    later = spark.createDataFrame([("k9", 1e9)], "city string, price_per_sqm double")
    model = fit_target_encoding(train, ("city",), smoothing=0.0)
    assert [r.city_enc for r in apply_target_encoding(later, model).collect()] == [4.0]
    assert sorted(r.value for r in model.mapping.collect()) == ["k1", "k2", "k3"]


def test_smoothing_null_keys_and_literal_none(spark):
    train = spark.createDataFrame(
        [("a", 10.0), ("a", 30.0), (None, 1000.0), ("None", 50.0), ("b", None)], "city string, price_per_sqm double"
    )
    model = fit_target_encoding(train, ("city",), smoothing=10.0)
    g = (10 + 30 + 1000 + 50) / 4
    assert model.global_mean == pytest.approx(g)
    encoded = {r.city: r.city_enc for r in apply_target_encoding(train, model).collect()}
    assert encoded["a"] == pytest.approx((2 * 20 + 10 * g) / 12)
    assert encoded[None] == pytest.approx(g)
    assert encoded["None"] == pytest.approx((50 + 10 * g) / 11)
    assert encoded["b"] == pytest.approx(g)  # all its targets are null


def test_all_null_target_raises(spark):
    df = spark.createDataFrame([("a", None)], "city string, price_per_sqm double")
    with pytest.raises(ValueError):
        fit_target_encoding(df, ("city",))


def test_empty_mapping_gives_global_mean(spark):
    df = spark.createDataFrame([(None, 10.0), (None, 20.0)], "city string, price_per_sqm double")
    model = fit_target_encoding(df, ("city",))
    assert model.sizes == {"city": 0}
    assert {r.city_enc for r in apply_target_encoding(df, model).collect()} == {15.0}


def _plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_broadcast_and_shuffle_join_agree_and_roundtrip(spark, tmp_path):
    rows = [(f"c{i % 17}" if i % 3 else None, f"d{i % 5}", float(i)) for i in range(600)]
    df = spark.createDataFrame(rows, "city string, district string, price_per_sqm double")
    model = fit_target_encoding(df, ("city", "district"))
    small = apply_target_encoding(df, model)
    assert "BroadcastHashJoin" in _plan(small)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = apply_target_encoding(df, model, broadcast_rows=0)
        plan = _plan(large)
        # The frequent values are broadcast, the others shuffled.
        assert "SortMergeJoin" in plan
        assert large.exceptAll(small).count() == 0 and large.count() == 600
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    model.save(str(tmp_path / "enc"))
    loaded = TargetEncodingModel.load(spark, str(tmp_path / "enc"))
    assert loaded.global_mean == model.global_mean and loaded.sizes == model.sizes
    assert apply_target_encoding(df, loaded).exceptAll(small).count() == 0


@pytest.mark.parametrize("hot_values", [2, 10, 10_000])
def test_large_mapping_splits_by_frequency(spark, monkeypatch, hot_values):
    """A value with half of all rows, nulls with a quarter, unseen values: the same as a broadcast join gives."""
    monkeypatch.setattr(encoding, "HOT_VALUES", hot_values)
    rows = [("hot" if k % 2 else None if k % 4 else f"v{k % 300}", float(k % 13)) for k in range(4000)]
    df = spark.createDataFrame(rows, "city string, price_per_sqm double").withColumn("m", F.expr("map('a', 1)"))
    model = fit_target_encoding(df.drop("m"), ("city",))
    other = df.unionByName(df.limit(3).withColumn("city", F.lit("unseen")))
    small, large = apply_target_encoding(other, model), apply_target_encoding(other, model, broadcast_rows=0)
    assert large.drop("m").exceptAll(small.drop("m")).count() == 0 and large.count() == 4003 and large.columns == small.columns
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        large = apply_target_encoding(other, model, broadcast_rows=0)
        sizes = large.where("city = 'hot'").groupBy(F.spark_partition_id().alias("p")).count().collect()
        # Rows of the hot value need no match in the shuffle and are dealt over its partitions.
        assert hot_values < 10 or max(r["count"] for r in sizes) < 1500
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_broadcast_needs_few_bytes_too(spark):
    df = spark.createDataFrame([("x" * 1000,)] * 20, "t string")
    other = spark.createDataFrame([("x" * 1000,)], "t string")
    assert "BroadcastHashJoin" in _plan(other.join(broadcast_if_small(df, 100), "t"))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" not in _plan(other.join(broadcast_if_small(df, 100, max_bytes=10_000), "t"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_insample_encoding_adds_columns(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 3.0)], "city string, price_per_sqm double")
    out = add_target_encodings(df, ("city",), smoothing=0.0)
    assert {r.city: r.city_enc for r in out.collect()} == {"a": 1.0, "b": 3.0}
