"""The whole cleaning job: drop → dedup → parse → impute → critical filter →
payment rules → target → outlier trim, with its funnel report.

Jobs at scale: an exact, column-pruned input count; the dedup shuffle runs
once and its result is materialized (a Parquet table in
``spark.checkpoint.dir`` when the cluster names one, else a MEMORY_AND_DISK
persist); room medians and outlier limits come from one exact-quantile pass
(one job when the input fits ``final_rows``, bounded refinement rounds
otherwise) and all report counters from one aggregate.  The cleaned frame
itself stays a lazy filter over the materialized rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from aqarlens.operators.cleaning import (
    AREA_BOUNDS,
    CRITICAL_COLUMNS,
    PRICE_PER_SQM_BOUNDS,
    PRICE_QUANTILES,
    TARGET,
    add_target,
    dedup_by_key,
    drop_irrelevant_columns,
    fill_defaults,
    fit_cleaning_values,
    key_load,
    parse_listing_columns,
    standardize_payment_method,
)
from aqarlens.session import materialize, resolve_mode

@dataclass
class CleaningReport:
    initial_rows: int
    final_rows: int
    dropped_columns: int
    duplicates_removed: int
    critical_nulls_removed: int
    payment_rows_standardized_unknown: int
    outliers_removed: int
    bedroom_median: float
    bathroom_median: float
    min_price_per_sqm: float | None
    max_price_per_sqm: float | None

    def check(self) -> None:
        """initial − duplicates − critical − outliers = final."""
        expected = self.initial_rows - self.duplicates_removed - self.critical_nulls_removed - self.outliers_removed
        if expected != self.final_rows:
            raise AssertionError(f"cleaning funnel does not add up: {expected} != {self.final_rows}")

    def to_frame(self, spark) -> DataFrame:
        """Long form ``(metric, value)`` in field order."""
        rows = [(name, None if value is None else float(value)) for name, value in asdict(self).items()]
        return spark.createDataFrame(rows, "metric string, value double")


def critical_condition_for(df: DataFrame, columns: Sequence[str] = CRITICAL_COLUMNS) -> Column:
    """No null (or NaN, for floating columns) in the critical columns; price, area > 0."""
    types = {field.name: field.dataType for field in df.schema.fields}
    condition = F.lit(True)
    for name in columns:
        condition = condition & F.col(name).isNotNull()
        if isinstance(types.get(name), (DoubleType, FloatType)):
            condition = condition & ~F.isnan(F.col(name))
    return condition & (F.col("price_egp") > 0) & (F.col("area_value") > 0)


@dataclass
class CleaningModel:
    """Fitted values of one cleaning run; re-applied to new rows when scoring."""

    bedroom_median: float
    bathroom_median: float
    price_per_sqm_low: float | None
    price_per_sqm_high: float | None
    area_low: float
    area_high: float


def clean_property_data(
    raw: DataFrame,
    key: str = "listing_id",
    dedup_order: Sequence[str] | None = None,
    drop_columns: Sequence[str] | None = None,
    price_quantiles: tuple[float, float] = PRICE_QUANTILES,
    area_bounds: tuple[float, float] = AREA_BOUNDS,
    price_per_sqm_bounds: tuple[float, float] = PRICE_PER_SQM_BOUNDS,
    quantile_method: str = "exact",
    keep_null_keys: bool = False,
    materialize_mode: str = "auto",
    deduped: DataFrame | None = None,
) -> tuple[DataFrame, CleaningReport, CleaningModel]:
    """Clean raw listings → (cleaned rows, funnel report, fitted values).

    ``deduped`` is ``raw`` with one row per key, from a source that drops
    duplicates before it derives its columns; ``key``, ``dedup_order`` and
    ``keep_null_keys`` are not used then.
    """
    dropped, dropped_count = drop_irrelevant_columns(raw, drop_columns)
    # An exact, column-pruned count: an Observation on the input would ride
    # along for free, but accumulators in a map stage are re-applied when the
    # stage re-runs after an executor loss, so the funnel could double count.
    if deduped is None:
        load = key_load(dropped, key)
        initial, _ = load
        unique = dedup_by_key(dropped, key, dedup_order, keep_null_keys=keep_null_keys, load=load)
    else:
        initial = dropped.count()
        unique, _ = drop_irrelevant_columns(deduped, drop_columns)
    mode = resolve_mode(raw.sparkSession, materialize_mode)
    staged = materialize(parse_listing_columns(unique), mode)

    bed, bath, limits = fit_cleaning_values(
        staged, critical_condition_for(staged), price_quantiles, area_bounds, price_per_sqm_bounds, quantile_method,
        row_hint=initial,
    )
    prepared = add_target(standardize_payment_method(fill_defaults(staged, bed, bath)))
    survives = critical_condition_for(prepared)
    keep = survives & limits.condition()

    counts = prepared.agg(
        F.count(F.lit(1)).alias("deduped"),
        F.count_if(~survives).alias("critical"),
        F.count_if(survives & (F.col("payment_method") == "unknown")).alias("unknown"),
        F.count_if(survives & ~F.coalesce(keep, F.lit(False))).alias("outliers"),
        F.count_if(F.coalesce(keep, F.lit(False))).alias("final"),
        F.min(F.when(keep, F.col(TARGET))).alias("low"),
        F.max(F.when(keep, F.col(TARGET))).alias("high"),
    ).first()
    report = CleaningReport(
        initial_rows=initial,
        final_rows=int(counts["final"]),
        dropped_columns=dropped_count,
        duplicates_removed=initial - int(counts["deduped"]),
        critical_nulls_removed=int(counts["critical"]),
        payment_rows_standardized_unknown=int(counts["unknown"]),
        outliers_removed=int(counts["outliers"]),
        bedroom_median=float(bed),
        bathroom_median=float(bath),
        min_price_per_sqm=None if counts["low"] is None else float(counts["low"]),
        max_price_per_sqm=None if counts["high"] is None else float(counts["high"]),
    )
    model = CleaningModel(
        bed, bath, limits.price_per_sqm_low, limits.price_per_sqm_high, limits.area_low, limits.area_high
    )
    cleaned = prepared.where(keep)
    return cleaned, report, model
