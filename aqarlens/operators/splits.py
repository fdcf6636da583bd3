"""Splits, unions and samples.

All of them are rules on a hash of the row, so a row's fate depends neither
on the partitioning nor on the order of rows, and a plan that is evaluated
twice picks the same rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Defaults of the original job.
SPLIT_NAMES = ("train", "validation", "test")
TEST_SIZE = 0.2
VALIDATION_SIZE = 0.2
SEED = 42
HASH_DIGITS = 8


def split_fractions(test_size: float = TEST_SIZE, validation_size: float = VALIDATION_SIZE) -> tuple[float, float, float]:
    train = 1.0 - test_size - validation_size
    if train <= 0:
        raise ValueError(f"test ({test_size}) and validation ({validation_size}) leave nothing to train on")
    return train, validation_size, test_size


def _digits(text: Column) -> Column:
    """The first hex digits of md5; compared as text they order like the number they spell."""
    return F.substring(F.md5(text), 1, HASH_DIGITS)


def _row_text(df: DataFrame) -> Column:
    """The whole row as text, for rows whose key is null."""
    return F.to_json(F.struct(*[F.col(name) for name in sorted(df.columns)]))


def hash_split_column(
    key: str | Column,
    fractions: Sequence[float] = (0.6, 0.2, 0.2),
    names: Sequence[str] = SPLIT_NAMES,
) -> Column:
    """Split name from the first 8 hex digits of ``md5(key)``; the last name for a null key."""
    if len(fractions) != len(names):
        raise ValueError("one fraction per split name")
    total = float(sum(fractions))
    prefix = _digits((F.col(key) if isinstance(key, str) else key).cast("string"))
    cumulative = 0.0
    rule = None
    for fraction, name in zip(fractions[:-1], names[:-1]):
        cumulative += fraction / total
        threshold = format(min(int(cumulative * 16**HASH_DIGITS), 16**HASH_DIGITS - 1), f"0{HASH_DIGITS}x")
        condition = prefix < F.lit(threshold)
        rule = F.when(condition, F.lit(name)) if rule is None else rule.when(condition, F.lit(name))
    return F.lit(names[-1]) if rule is None else rule.otherwise(F.lit(names[-1]))


def hash_split(
    df: DataFrame,
    key: str = "listing_id",
    test_size: float = TEST_SIZE,
    validation_size: float = VALIDATION_SIZE,
    column: str = "split",
) -> DataFrame:
    """Tag each row by its key; rows with a null key are dealt by their whole content."""
    text = F.coalesce(F.col(key).cast("string"), _row_text(df))
    return df.withColumn(column, hash_split_column(text, split_fractions(test_size, validation_size)))


def split_frames(df: DataFrame, column: str = "split", names: Sequence[str] = SPLIT_NAMES) -> dict[str, DataFrame]:
    return {name: df.where(F.col(column) == name).drop(column) for name in names}


def random_split(
    df: DataFrame,
    test_size: float = TEST_SIZE,
    validation_size: float = VALIDATION_SIZE,
    seed: int = SEED,
    key: str = "listing_id",
) -> dict[str, DataFrame]:
    """Seeded 60/20/20 split: each row is tagged once, from a hash of (seed, key)."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), _row_text(df)))
    tagged = df.withColumn("__split", hash_split_column(text, split_fractions(test_size, validation_size)))
    return split_frames(tagged, "__split")


def union_splits(frames: Mapping[str, DataFrame], column: str | None = None) -> DataFrame:
    """UNION ALL by name, optionally tagging each row with its split."""
    out = None
    for name, frame in frames.items():
        part = frame.withColumn(column, F.lit(name)) if column else frame
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("no frames to union")
    return out


def _drawn(df: DataFrame, key: str, fraction: float, seed: int) -> Column:
    """Whether a row falls into a sample of this share, by a hash of (seed, key)."""
    if fraction >= 1:
        return F.lit(True)
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), _row_text(df)))
    return _digits(text) < F.lit(format(int(fraction * 16**HASH_DIGITS), f"0{HASH_DIGITS}x"))


def map_sample(df: DataFrame, sample_size: int = 5_000, seed: int = SEED, key: str = "listing_id") -> DataFrame:
    """A sample of about ``sample_size`` rows (share min(size, n) / n)."""
    total = df.count()
    return df.where(_drawn(df, key, min(sample_size, total) / total if total else 0.0, seed))


def segment_sample(
    df: DataFrame,
    column: str = "category",
    fractions: Mapping[str, float] | None = None,
    seed: int = SEED,
    key: str = "listing_id",
    caps: Mapping[str, Column] | None = None,
) -> DataFrame:
    """A sample of each segment (20% of buy, 50% of rent by default), of rows inside the segment's caps."""
    picked = F.lit(False)
    for name, fraction in (fractions or {"buy": 0.2, "rent": 0.5}).items():
        inside = F.coalesce(caps[name], F.lit(False)) if caps and name in caps else F.lit(True)
        picked = picked | ((F.col(column) == name) & inside & _drawn(df, key, fraction, seed))
    return df.where(picked)
