"""Smoothed target encoding as a mapping DataFrame plus left joins.

encoded(value) = (n·mean + s·G) / (n + s), with n the non-null targets of the
value, ``s`` the smoothing and ``G`` the global mean target.  Unseen values
and null keys get ``G``.

Fit: the category columns are unpivoted to ``(column, value, target)`` and
aggregated once (partial aggregation map-side, so a value holding a third
of all rows is combined before the shuffle).  Apply: one left join per
column.  The mapping side is broadcast only when its counted rows and bytes
are under bounds; of a larger mapping the frequent values are broadcast and
the others joined by a shuffle.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aqarlens.operators.features import add_listing_features
from aqarlens.operators.joins import DEFAULT_BROADCAST_BYTES, row_bytes
from aqarlens.session import materialize

# Defaults of the original job.
DEFAULT_CATEGORICAL_COLUMNS = ("city", "town", "district", "property_type")
DEFAULT_TARGET = "price_per_sqm"
DEFAULT_SMOOTHING = 10.0
NULL_KEYS = 4096
#: A value with one row in so many is frequent; there are so many frequent values at most.
HOT_VALUES = 1000
BROADCAST_ROWS = 200_000
MAPPING_SCHEMA = "column string, value string, mean double, count long, encoded double"


@dataclass
class TargetEncodingModel:
    global_mean: float
    columns: tuple[str, ...]
    smoothing: float
    mapping: DataFrame
    sizes: dict[str, int] = field(default_factory=dict)
    _bounds: dict[str, tuple[int, int, int]] | None = None

    def bounds(self, column: str) -> tuple[int, int, int]:
        """(values, bytes, fitted rows) of a column's mapping, counted once for all columns."""
        if self._bounds is None:
            counted = self.mapping.groupBy("column").agg(
                F.count(F.lit(1)).alias("n"), F.sum(row_bytes(self.mapping)).alias("size"), F.sum("count").alias("rows")
            )
            self._bounds = {r["column"]: (r["n"], r["size"], r["rows"] or 0) for r in counted.collect()}
        return self._bounds.get(column, (0, 0, 0))

    def save(self, path: str) -> None:
        """Mapping as Parquet, scalars as one JSON row, both written by Spark."""
        self.mapping.write.mode("overwrite").parquet(f"{path}/mapping")
        meta = {
            "global_mean": self.global_mean,
            "columns": list(self.columns),
            "smoothing": self.smoothing,
            "sizes": self.sizes,
        }
        spark = self.mapping.sparkSession
        spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode("overwrite").text(
            f"{path}/meta"
        )

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "TargetEncodingModel":
        meta = json.loads(spark.read.text(f"{path}/meta").first()["value"])
        mapping = spark.read.schema(MAPPING_SCHEMA).parquet(f"{path}/mapping")
        return cls(
            float(meta["global_mean"]),
            tuple(meta["columns"]),
            float(meta["smoothing"]),
            mapping,
            {k: int(v) for k, v in meta["sizes"].items()},
        )


def category_stats(df: DataFrame, columns: Iterable[str], target: str) -> DataFrame:
    """``(column, value, total, count)`` of the target per category value, in
    one aggregate over the unpivoted columns.  Null values are kept as a
    group, so each column's groups cover every row: the global mean is
    Σtotal / Σcount over any one column."""
    columns = list(columns)
    stacked = df.select(
        F.col(target).cast("double").alias("__target"),
        *[F.col(name).cast("string").alias(name) for name in columns],
    ).unpivot(["__target"], columns, "column", "value")
    return stacked.groupBy("column", "value").agg(
        F.sum("__target").alias("total"), F.count("__target").alias("count")
    )


def mapping_from_stats(stats: DataFrame, smoothing: float, mean: float) -> DataFrame:
    """Lazy mapping ``(column, value, mean, count, encoded)``; null values dropped."""
    value_mean = F.try_divide(F.col("total"), F.col("count"))
    weighted = F.col("count") * F.coalesce(value_mean, F.lit(0.0)) + F.lit(float(smoothing) * mean)
    encoded = F.coalesce(F.try_divide(weighted, F.col("count") + F.lit(float(smoothing))), F.lit(mean))
    return stats.where(F.col("value").isNotNull()).select(
        "column", "value", value_mean.alias("mean"), "count", encoded.alias("encoded")
    )


def fit_target_encoding(
    df: DataFrame,
    columns: Iterable[str] = DEFAULT_CATEGORICAL_COLUMNS,
    target: str = DEFAULT_TARGET,
    smoothing: float = DEFAULT_SMOOTHING,
    materialize_mode: str = "auto",
) -> TargetEncodingModel:
    """One scan of ``df`` (the unpivoted aggregate, materialized), then one
    small aggregate over it for the global mean and the mapping sizes."""
    columns = tuple(columns)
    if not columns:
        raise ValueError("no categorical column to encode")
    stats = materialize(category_stats(df, columns, target), materialize_mode)
    summary = {
        row["column"]: row
        for row in stats.groupBy("column")
        .agg(
            F.count_if(F.col("value").isNotNull()).alias("size"),
            F.sum("total").alias("total"),
            F.sum("count").alias("n"),
        )
        .collect()
    }
    first = summary.get(columns[0])
    if first is None or not first["n"]:
        raise ValueError(f"column {target!r} is null in every row, so there is no mean to encode with")
    mean = float(first["total"]) / float(first["n"])
    sizes = {name: int(summary[name]["size"]) if name in summary else 0 for name in columns}
    return TargetEncodingModel(mean, columns, float(smoothing), mapping_from_stats(stats, smoothing, mean), sizes)


def _encode_column(
    df: DataFrame,
    name: str,
    lookup: DataFrame,
    bounds: tuple[int, int, int],
    fallback: float,
    broadcast_rows: int,
) -> DataFrame:
    """Left join with the column's mapping, broadcast if its rows and bytes are few, else split by frequency.

    The fit counted each value, so a large mapping names its frequent values:
    those with at least one row in ``HOT_VALUES``, of which there are so many at
    most.  They are broadcast; the other values go through a shuffle join.  There
    the rows that need no match any more, and null keys, would meet in one task;
    each gets a key of its own kind, spread over ``NULL_KEYS`` values that begin
    with a control character and stay unmatched.
    """
    enc = f"{name}_enc"
    rows, size_bytes, total = bounds
    if rows == 0:
        return df.withColumn(enc, F.lit(fallback))
    key = F.col(name).cast("string")
    side = lookup.select(F.col("value").alias("__key"), F.col("encoded").alias("__enc"), F.col("count").alias("__rows"))
    if rows <= broadcast_rows and size_bytes <= DEFAULT_BROADCAST_BYTES:
        joined = df.join(F.broadcast(side.drop("__rows")), key == F.col("__key"), "left")
        return joined.withColumn(enc, F.coalesce(F.col("__enc"), F.lit(fallback))).drop("__key", "__enc")
    frequent = F.col("__rows") * HOT_VALUES >= total
    hot = side.where(frequent).select(F.col("__key").alias("__hot"), F.col("__enc").alias("__hot_enc"))
    cold = side.where(~frequent).drop("__rows")
    flat = [field.name for field in df.schema.fields if "map<" not in field.dataType.simpleString()]
    spread = F.concat(F.lit("\0"), F.pmod(F.xxhash64(*flat), F.lit(NULL_KEYS)).cast("string"))
    marked = df.join(F.broadcast(hot), key == F.col("__hot"), "left")
    open_key = F.when(F.col("__hot").isNull(), key)
    joined = marked.withColumn("__open", F.coalesce(open_key, spread)).join(cold, F.col("__open") == F.col("__key"), "left")
    value = F.coalesce("__hot_enc", "__enc", F.lit(fallback))
    return joined.withColumn(enc, value).drop("__open", "__hot", "__hot_enc", "__key", "__enc")


def apply_target_encoding(
    df: DataFrame,
    model: TargetEncodingModel,
    broadcast_rows: int = BROADCAST_ROWS,
    columns: Iterable[str] | None = None,
) -> DataFrame:
    """Add ``<column>_enc`` for each model column (or only ``columns``);
    unseen / null → global mean."""
    out = df
    wanted = model.columns if columns is None else tuple(columns)
    for name in wanted:
        lookup = model.mapping.where(F.col("column") == name)
        out = _encode_column(out, name, lookup, model.bounds(name), model.global_mean, broadcast_rows)
    return out


def build_model_features(
    df: DataFrame, columns: Iterable[str] = DEFAULT_CATEGORICAL_COLUMNS, target: str = DEFAULT_TARGET, **listing_options
) -> DataFrame:
    """Listing features and in-sample encodings of cleaned rows: everything the models read."""
    return add_target_encodings(add_listing_features(df, **listing_options), columns, target)


def add_target_encodings(
    df: DataFrame,
    columns: Iterable[str] = DEFAULT_CATEGORICAL_COLUMNS,
    target: str = DEFAULT_TARGET,
    smoothing: float = DEFAULT_SMOOTHING,
    broadcast_rows: int = BROADCAST_ROWS,
    materialize_mode: str = "auto",
) -> DataFrame:
    """Fit and apply on the same rows (in-sample; leaks the target)."""
    model = fit_target_encoding(df, columns, target, smoothing, materialize_mode)
    return apply_target_encoding(df, model, broadcast_rows)
