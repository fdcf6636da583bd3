from __future__ import annotations

import datetime as dt

from aqarlens.functions import features as fx
from aqarlens.operators.features import add_listing_features


def _listing(spark, **overrides):
    row = {
        "amenities": None, "listed_date": None, "bedrooms": 2.0, "bathrooms": 1.0, "area_value": 100.0,
        "furnished": "NO", "completion_status": "unknown", "payment_method": "unknown",
    }
    row.update(overrides)
    schema = (
        "amenities string, listed_date string, bedrooms double, bathrooms double, area_value double, "
        "furnished string, completion_status string, payment_method string"
    )
    return spark.createDataFrame([tuple(row[k] for k in row)], schema)


def test_every_amenity_has_its_own_flag():
    assert len(dict(fx.AMENITY_FEATURES)) == len({flag for _, flag in fx.AMENITY_FEATURES}) == 9


def test_amenity_counts_and_substring_flags(spark):
    rows = [None, "", "  ", "a|b|", "|", "Private Pool", "Storage Space"]
    df = spark.createDataFrame([(r,) for r in rows], "amenities string")
    out = df.select(
        fx.amenity_count().alias("n"),
        fx.amenity_flag("Pool").alias("pool"),
        fx.amenity_flag("Private Pool").alias("private"),
        fx.amenity_flag("Spa").alias("spa"),
        fx.amenity_flag("Spa", match="token").alias("spa_token"),
    ).collect()
    assert [r.n for r in out] == [0, 0, 0, 3, 2, 1, 1]
    assert (out[5].pool, out[5].private) == (1, 1)
    assert (out[6].spa, out[6].spa_token) == (1, 0)


def test_days_listed(spark):
    values = [None, "junk", "2026-03-04", "2026-03-10", "2026-03-01T00:00:00Z"]
    df = spark.createDataFrame([(v,) for v in values], "listed_date string")
    got = [r[0] for r in df.select(fx.days_listed("listed_date", df.schema["listed_date"].dataType)).collect()]
    assert got == [-1, -1, 1, -5, 4]
    ts = spark.createDataFrame([(dt.datetime(2026, 3, 1, 23, 0),)], "listed_date timestamp_ntz")
    assert ts.select(fx.days_listed("listed_date", ts.schema["listed_date"].dataType)).first()[0] == 4


def test_ratio_features_guard_zero(spark):
    df = _listing(spark, bedrooms=0.0, bathrooms=0.0)
    row = add_listing_features(df).first()
    assert row.bed_bath_ratio == 0.0
    assert row.total_rooms == 0.0
    assert row.area_per_room == 100.0


def test_status_features(spark):
    df = spark.createDataFrame(
        [(" yes ", "Completed_Primary", "cash | installments"), (None, "off_plan", "both"), ("NO", None, "cash")],
        "furnished string, completion_status string, payment_method string",
    )
    out = df.select(fx.is_furnished(), fx.completion_score(), fx.has_installments()).collect()
    assert [tuple(r) for r in out] == [(1, 2, 1), (None, 0, 1), (0, 1, 0)]


def test_flags_normalised_in_place(spark):
    df = _listing(spark).withColumn("is_premium", fx.F.lit("True"))
    out = add_listing_features(df)
    assert out.columns.count("is_premium") == 1
    assert out.first().is_premium == 1
