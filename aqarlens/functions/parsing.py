"""Cleaning scalars as Catalyst expressions (no UDFs).

Each helper takes a column name and, where the behaviour depends on it, the
column's Spark type: text is parsed, numbers are only cast.  Parsing text
form of a double (``1.0E7``) would strip the exponent and corrupt it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, NumericType, StringType

# Numeric text accepted by the parsers (``3``, ``3.``, ``3.5``;
# not ``.5``, ``-3``, ``1e3`` or empty), the capped room marker, the studio
# word, and the characters kept when amounts are stripped.
NUMERIC_PATTERN = r"^[0-9]+(\.[0-9]*)?$"
CAPPED_ROOMS_PATTERN = r"^7\+$"
CAPPED_ROOMS_VALUE = 7.0
STUDIO_WORD = "studio"
STUDIO_ROOMS = 1.0
AMOUNT_STRIP_PATTERN = r"[^0-9.]"
TRUE_WORDS = ("true", "1", "yes")


def _is_text(dtype: DataType | None) -> bool:
    return dtype is None or isinstance(dtype, StringType)


def parse_room_count(name: str, dtype: DataType | None = None, allow_studio: bool = True) -> Column:
    """Room text → double: trims; ``studio`` (any case) → 1; ``7+`` → 7;
    numeric text → its value; anything else → null."""
    if not _is_text(dtype):
        return F.col(name).try_cast("double") if isinstance(dtype, NumericType) else F.lit(None).cast("double")
    text = F.trim(F.col(name))
    branches = [(F.lower(text) == STUDIO_WORD, F.lit(STUDIO_ROOMS))] if allow_studio else []
    branches.append((text.rlike(CAPPED_ROOMS_PATTERN), F.lit(CAPPED_ROOMS_VALUE)))
    branches.append((text.rlike(NUMERIC_PATTERN), text.try_cast("double")))
    rule = F.when(*branches[0])
    for condition, value in branches[1:]:
        rule = rule.when(condition, value)
    return rule.otherwise(F.lit(None).cast("double"))


def parse_amount(name: str, dtype: DataType | None = None) -> Column:
    """Money / area / count text → double.

    Text: every character except digits and dots is removed
    (``EGP 1,250,000`` → 1250000, a minus sign is dropped), then the rest
    must be numeric text (``1.2.3`` → null).  Numbers are cast unchanged.
    """
    if not _is_text(dtype):
        return F.col(name).try_cast("double") if isinstance(dtype, NumericType) else F.lit(None).cast("double")
    stripped = F.regexp_replace(F.col(name), AMOUNT_STRIP_PATTERN, "")
    return F.when(stripped.rlike(NUMERIC_PATTERN), stripped.try_cast("double")).otherwise(
        F.lit(None).cast("double")
    )


def try_double(name: str) -> Column:
    """Null instead of an ANSI cast error on bad text."""
    return F.col(name).try_cast("double")


def flag_to_int(name: str) -> Column:
    """Boolean-ish value → 1/0: string form lower/trimmed in
    {true, 1, yes} → 1; anything else, null included → 0."""
    text = F.lower(F.trim(F.coalesce(F.col(name).cast("string"), F.lit(""))))
    return F.when(text.isin(*TRUE_WORDS), F.lit(1)).otherwise(F.lit(0))


def safe_denominator(value: Column) -> Column:
    """0 → 1.0, anything else itself (null stays null)."""
    return F.when(value == 0, F.lit(1.0)).otherwise(value)


def normalized_text(name: str) -> Column:
    """lower(trim(x)) with null read as the empty string."""
    return F.lower(F.trim(F.coalesce(F.col(name), F.lit(""))))
