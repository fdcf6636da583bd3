"""An empty listings table through every operator: empty in, empty (or
documented defaults) out, never an error from the data."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from aqarlens.catalog import queries as q
from aqarlens.operators import profiling
from aqarlens.operators.encoding import fit_target_encoding
from aqarlens.operators.features import add_listing_features
from aqarlens.operators.splits import hash_split, map_sample, segment_sample
from aqarlens.plans.cleaning import clean_property_data
from aqarlens.plans.training import prepare_model_data


@pytest.fixture(scope="module")
def empty_raw(spark, sf_dir):
    return q.raw(spark, sf_dir).limit(0)


def test_empty_listings_through_operators(spark, empty_raw):
    cleaned, report, model = clean_property_data(empty_raw)
    assert cleaned.count() == 0 and report.final_rows == 0
    featured = add_listing_features(cleaned)
    assert featured.count() == 0 and "amenity_count" in featured.columns
    assert hash_split(featured).count() == 0
    assert map_sample(featured).count() == 0
    assert segment_sample(featured).count() == 0
    assert {r["missing_count"] for r in profiling.missing_values(featured).collect()} == {0}
    assert profiling.feature_summary(featured, ["area_value"]).first()["non_null"] == 0
    assert profiling.category_shares(featured).count() == 0
    assert profiling.top_k_counts(featured).count() == 0
    assert profiling.correlation_matrix(featured, ["area_value", "lat"]).first()["pearson_r"] is None
    with pytest.raises(ValueError):
        fit_target_encoding(featured, ("city",))
    with pytest.raises(ValueError):
        prepare_model_data(featured.withColumns({f"{c}_enc": F.lit(1.0) for c in ("city", "town", "district", "property_type")}))
