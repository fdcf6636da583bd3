"""Size-checked broadcast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

DEFAULT_BROADCAST_ROWS = 200_000
DEFAULT_BROADCAST_BYTES = 64 << 20
#: Bytes a row takes besides its text, at a generous guess.
ROW_BYTES = 64


def row_bytes(df: DataFrame) -> Column:
    """About how many bytes a row of flat columns takes."""
    texts = [F.coalesce(F.octet_length(F.col(f.name)), F.lit(0)) for f in df.schema.fields if isinstance(f.dataType, StringType)]
    return sum(texts, F.lit(ROW_BYTES)).cast("long")


def broadcast_if_small(
    df: DataFrame,
    max_rows: int = DEFAULT_BROADCAST_ROWS,
    known_size: tuple[int, int] | None = None,
    max_bytes: int = DEFAULT_BROADCAST_BYTES,
) -> DataFrame:
    """Mark ``df`` for broadcast only when both its rows and its bytes are within bounds.

    ``known_size`` (rows, bytes) skips the count when it is already known
    (e.g. taken when a mapping was fitted).  Larger inputs are returned as
    they are, so the planner picks a shuffle join and AQE can split skew.
    """
    rows, size = known_size or df.agg(F.count(F.lit(1)), F.sum(row_bytes(df))).first()
    return F.broadcast(df) if rows <= max_rows and (size or 0) <= max_bytes else df
