"""Listing feature scalars as Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, StringType, TimestampNTZType, TimestampType

from aqarlens.functions.parsing import normalized_text, safe_denominator

# Amenity keyword → output flag, matched as a case-insensitive
# substring of the whole amenity text (so "Private Pool" also sets has_pool).
AMENITY_FEATURES = (
    ("Pool", "has_pool"),
    ("Gym", "has_gym"),
    ("Security", "has_security"),
    ("Parking", "has_parking"),
    ("Garden", "has_garden"),
    ("Balcony", "has_balcony"),
    ("Private Pool", "has_private_pool"),
    ("Spa", "has_spa"),
    ("A/C", "has_ac"),
)
AMENITY_SEPARATOR = "|"

# Flag columns normalised to 1/0 when present.
BOOLEAN_FLAG_COLUMNS = ("is_premium", "is_verified", "is_new_construction", "is_direct_from_dev")

# Completion status words scored 2 and 0 (anything else 1).
COMPLETED_STATUSES = ("completed", "completed_primary")
OFF_PLAN_STATUSES = ("off_plan", "off_plan_primary")

DEFAULT_REFERENCE_DATE = "2026-03-05"
MISSING_DAYS = -1


def amenity_count(name: str = "amenities") -> Column:
    """Number of ``|``-separated parts (trailing empties count); 0 when null/blank."""
    text = F.col(name)
    return F.when(
        text.isNotNull() & (F.trim(text) != ""), F.size(F.split(text, r"\|", -1))
    ).otherwise(F.lit(0))


def amenity_flag(keyword: str, name: str = "amenities", match: str = "substring") -> Column:
    """1 when the keyword occurs in the amenity text (case-insensitive)."""
    text = F.lower(F.coalesce(F.col(name), F.lit("")))
    if match == "token":
        parts = F.transform(F.split(text, r"\|", -1), lambda part: F.trim(part))
        return F.array_contains(parts, keyword.lower()).cast("int")
    return (F.instr(text, keyword.lower()) > 0).cast("int")


def days_listed(
    name: str = "listed_date", dtype: DataType | None = None, reference_date: str = DEFAULT_REFERENCE_DATE
) -> Column:
    """Days from the listing date to the reference date; −1 when missing or unparsable."""
    if isinstance(dtype, DateType):
        listed = F.col(name)
    elif isinstance(dtype, (TimestampType, TimestampNTZType)):
        listed = F.to_date(F.col(name))
    elif dtype is None or isinstance(dtype, StringType):
        listed = F.to_date(F.try_to_timestamp(F.col(name).cast("string")))
    else:
        listed = F.lit(None).cast("date")
    return F.coalesce(F.datediff(F.to_date(F.lit(reference_date)), listed), F.lit(MISSING_DAYS))


def bed_bath_ratio(bedrooms: str = "bedrooms", bathrooms: str = "bathrooms") -> Column:
    return F.round(F.col(bedrooms) / safe_denominator(F.col(bathrooms)), 2)


def total_rooms(bedrooms: str = "bedrooms", bathrooms: str = "bathrooms") -> Column:
    return F.col(bedrooms) + F.col(bathrooms)


def area_per_room(area: str = "area_value", bedrooms: str = "bedrooms", bathrooms: str = "bathrooms") -> Column:
    rooms = total_rooms(bedrooms, bathrooms)
    return F.col(area) / F.when(rooms == 0, F.lit(1.0)).otherwise(rooms)


def is_furnished(name: str = "furnished") -> Column:
    """1 for YES (trim, any case), 0 otherwise, null stays null."""
    return (F.upper(F.trim(F.col(name))) == F.lit("YES")).cast("int")


def completion_score(name: str = "completion_status") -> Column:
    status = F.lower(F.trim(F.col(name)))
    return (
        F.when(status.isin(*COMPLETED_STATUSES), F.lit(2))
        .when(status.isin(*OFF_PLAN_STATUSES), F.lit(0))
        .otherwise(F.lit(1))
    )


def has_installments(name: str = "payment_method") -> Column:
    method = normalized_text(name)
    return (method.contains("installments") | (method == "both")).cast("int")
