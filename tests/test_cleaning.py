from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from aqarlens.catalog.queries import QUERIES
from aqarlens.operators import cleaning
from aqarlens.operators.cleaning import add_target_and_remove_outliers, dedup_by_key, key_load
from aqarlens.plans.cleaning import clean_property_data
from aqarlens.sources.listings_view import TIE_COLUMNS, listings_view


def test_fixed_bounds_trim_price_and_area(spark):
    # Below and above the price bounds, below and above the area bounds, and three rows inside.
    rows = [(50.0 * 999, 50.0), (50.0 * 300_001, 50.0), (19.0 * 5000, 19.0), (1501.0 * 5000, 1501.0)]
    rows += [(a * p, a) for a, p in ((20.0, 1000.0), (1500.0, 300_000.0), (80.0, 7000.0))]
    df = spark.createDataFrame(rows, "price_egp double, area_value double")
    kept, removed, low, high = add_target_and_remove_outliers(df, price_quantiles=(0.0, 1.0))
    assert (kept.count(), removed, low, high) == (3, 4, 1000.0, 300_000.0)


def test_outlier_trim_on_empty_input(spark):
    df = spark.createDataFrame([], "price_egp double, area_value double")
    cleaned, removed, low, high = add_target_and_remove_outliers(df)
    assert cleaned.count() == 0 and removed == 0 and low is None and high is None


@pytest.mark.parametrize("mode", ["auto", "persist", "none"])
def test_cleaning_funnel_matches_fixture(spark, sf_dir, mode):
    # Expected funnel at sf0.001, computed independently in DuckDB.
    cleaned, report, _ = clean_property_data(listings_view(spark, sf_dir), dedup_order=TIE_COLUMNS, materialize_mode=mode)
    report.check()
    assert report.initial_rows == 6000
    assert report.duplicates_removed == 1401
    assert report.critical_nulls_removed == 502
    assert report.payment_rows_standardized_unknown == 1158
    assert report.outliers_removed == 1657
    assert report.final_rows == 2440 == cleaned.count()
    assert (report.bedroom_median, report.bathroom_median) == (4.0, 4.0)
    assert report.min_price_per_sqm == pytest.approx(1000.8571, abs=1e-4)
    assert report.max_price_per_sqm == pytest.approx(158620.5833, abs=1e-4)
    by_category = {r["category"]: r["count"] for r in cleaned.groupBy("category").count().collect()}
    assert by_category == {"buy": 2404, "rent": 36}


def test_cleaning_empty_input(spark):
    raw = spark.createDataFrame(
        [], "listing_id long, price_egp string, area_value string, lat double, lon double, bedrooms string, "
        "bathrooms string, furnished string, payment_method string"
    )
    cleaned, report, _ = clean_property_data(raw)
    assert cleaned.count() == 0
    assert report.initial_rows == report.final_rows == 0
    assert (report.bedroom_median, report.bathroom_median) == (2.0, 1.0)


def test_dedup_is_independent_of_partitioning(spark, sf_dir):
    raw = listings_view(spark, sf_dir)
    a = dedup_by_key(raw.repartition(3), "listing_id", TIE_COLUMNS)
    b = dedup_by_key(raw.repartition(7, "tie_price"), "listing_id", TIE_COLUMNS)
    assert a.count() == 4599
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_dedup_whole_row_order_and_null_keys(spark):
    df = spark.createDataFrame(
        [(1, "b"), (1, "a"), (None, "x"), (None, "y"), (2, None), (2, "c")], "listing_id long, v string"
    )
    default = {(r.listing_id, r.v) for r in dedup_by_key(df).collect()}
    assert default == {(1, "a"), (None, "x"), (2, None)}
    kept = dedup_by_key(df, keep_null_keys=True)
    assert kept.where(F.col("listing_id").isNull()).count() == 2
    assert kept.count() == 4


def test_dedup_hot_key_is_limited_map_side(spark):
    # One key holds a third of the rows; the plan must cut it per map task.
    rows = [(0 if i % 3 == 0 else i, i) for i in range(3000)]
    df = spark.createDataFrame(rows, "listing_id long, v long").repartition(6)
    out = dedup_by_key(df, "listing_id", ["v"])
    assert out.count() == 2001
    assert out.where("listing_id = 0").first()["v"] == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_sized_dedup_picks_the_same_rows(spark, monkeypatch):
    monkeypatch.setattr(cleaning, "TASK_ROWS", 100)
    rows = [(k % 150 if k % 3 else 7, k % 11, k) for k in range(900)] + [(None, k % 5 or None, k) for k in range(40)]
    df = spark.createDataFrame(rows, "listing_id long, v int, w long").repartition(3)
    load = key_load(df)
    assert load == (940, True)
    for keep in (False, True):
        plain = dedup_by_key(df, order_by=["v", "w"], keep_null_keys=keep)
        for hot in (True, False):
            sized = dedup_by_key(df, order_by=["v", "w"], keep_null_keys=keep, load=(load[0], hot))
            assert sorted(map(str, sized.collect())) == sorted(map(str, plain.collect()))
    assert key_load(df.where("listing_id > 7")) == (600 - sum(k % 150 <= 7 for k in range(900) if k % 3), False)
    assert key_load(df.limit(0)) == (0, False)


def test_dedup_of_listings_shuffles_sources_and_sizes_its_tasks(spark, sf_dir, monkeypatch):
    """Sorts held a whole input split of derived text, and spilled."""
    monkeypatch.setattr(cleaning, "TASK_ROWS", 1000)
    unique = QUERIES["dedup_listings"](spark, sf_dir)
    plan = unique._jdf.queryExecution().executedPlan().toString()
    above, below = plan[: plan.rindex("Exchange hashpartitioning(listing_id")], plan[plan.rindex("Exchange hashpartitioning(listing_id") :]
    assert re.match(r"Exchange hashpartitioning\(listing_id#\w+, 6\)", below)
    assert "WindowGroupLimit" in above and "WindowGroupLimit" not in below and "Sort " not in below.split("Scan parquet")[0]
    assert "EGP" in above and "EGP" not in below
    plain = dedup_by_key(listings_view(spark, sf_dir), "listing_id", TIE_COLUMNS)
    assert unique.count() == 4599 and unique.exceptAll(plain).count() == 0
