"""Listing features: one projection of built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aqarlens.functions import features as fx
from aqarlens.functions.parsing import flag_to_int


def listing_feature_columns(
    df: DataFrame,
    reference_date: str = fx.DEFAULT_REFERENCE_DATE,
    amenity_match: str = "substring",
) -> dict[str, Column]:
    """Feature name → expression, in output order."""
    types = {field.name: field.dataType for field in df.schema.fields}
    columns: dict[str, Column] = {"amenity_count": fx.amenity_count("amenities")}
    for keyword, name in fx.AMENITY_FEATURES:
        columns[name] = fx.amenity_flag(keyword, "amenities", amenity_match)
    columns.update(
        {
            "days_listed": fx.days_listed("listed_date", types.get("listed_date"), reference_date),
            "bed_bath_ratio": fx.bed_bath_ratio(),
            "total_rooms": fx.total_rooms(),
            "area_per_room": fx.area_per_room(),
            "area_x_beds": F.col("area_value") * F.col("bedrooms"),
            "log_area": F.log1p("area_value"),
            "is_furnished": fx.is_furnished(),
            "completion_score": fx.completion_score(),
            "has_installments": fx.has_installments(),
        }
    )
    for name in fx.BOOLEAN_FLAG_COLUMNS:
        if name in types:
            columns[name] = flag_to_int(name)
    return columns


def add_listing_features(
    df: DataFrame,
    reference_date: str = fx.DEFAULT_REFERENCE_DATE,
    amenity_match: str = "substring",
) -> DataFrame:
    """Append the listing features (flags normalised in place); one Project."""
    return df.withColumns(listing_feature_columns(df, reference_date, amenity_match))
