"""Query registry: every operator as a (Spark query, DuckDB oracle) pair.

Each query reads the driver's whole tables through the listings view and
returns a DataFrame; floating results that sum or divide in engine-specific
order are rounded on both sides.  Queries of iterative fits return properties
that must hold (row counts, signs, order); samples and splits are hash rules
that SQL computes alike.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aqarlens.catalog import oracles as sql
from aqarlens.functions import features as fx
from aqarlens.functions.parsing import flag_to_int, parse_amount, parse_room_count
from aqarlens.operators import profiling
from aqarlens.operators.cleaning import (
    clean_numeric_columns,
    dedup_by_key,
    drop_irrelevant_columns,
    fill_defaults,
    fit_room_medians,
    key_load,
    parse_listing_columns,
    payment_method_expr,
)
from aqarlens.operators.encoding import (
    TargetEncodingModel,
    add_target_encodings,
    build_model_features,
    apply_target_encoding,
    fit_target_encoding,
)
from aqarlens.operators.features import add_listing_features
from aqarlens.operators.quantiles import exact_quantiles_multi, quantile_table, sketch_quantiles
from aqarlens.operators.splits import hash_split, split_frames, union_splits
from aqarlens.plans.cleaning import clean_property_data, critical_condition_for
from aqarlens.plans.config import FEATURES, TARGET
from aqarlens.plans.training import prepare_model_data
from aqarlens.session import checkpoint_dir, drop_folders, materialize, own_folder
from aqarlens.sources.files import read_checked, read_listings, write_table
from aqarlens.sources.listings_view import (
    SOURCE_TIES,
    TIE_COLUMNS,
    VIEW_COLUMNS,
    derived_listings,
    listing_sources,
    listings_view,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

_MEMO: dict[tuple, object] = {}

ENC_COLUMNS = ("city", "town", "district", "property_type")
INT_FEATURES = {
    "amenity_count", "has_pool", "has_gym", "has_security", "has_parking", "has_garden", "has_balcony",
    "has_private_pool", "has_spa", "has_ac", "days_listed", "is_furnished", "completion_score",
    "has_installments", "is_premium", "is_verified", "is_new_construction", "is_direct_from_dev",
}
CLEAN_COLUMNS = [
    name for name, _ in VIEW_COLUMNS if name not in ("contact_phone", "agent_email", *TIE_COLUMNS)
] + [TARGET]
CORRELATION_COLUMNS = ("price_egp", "area_value", "bedrooms", "bathrooms", "lat", "lon", "price_per_sqm")
QUANTILE_COLUMNS = ("price_per_sqm", "area_value", "bedrooms", "bathrooms")
QUANTILE_PROBS = (0.01, 0.25, 0.5, 0.75, 0.99)


def register(name: str, oracle: str | None = None):
    def wrap(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return wrap


def reset() -> None:
    """Forget memoized upstream stages, unpersist them and remove their folders."""
    sessions = {}
    for value in _MEMO.values():
        frame = value[0] if isinstance(value, tuple) else value
        if isinstance(frame, DataFrame):
            frame.unpersist()
            sessions[id(frame.sparkSession)] = frame.sparkSession
    _MEMO.clear()
    for spark in sessions.values():
        drop_folders(spark)


def _memo(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], object]):
    key = (spark.conf.get("spark.app.id", None) or id(spark), sf_dir.rstrip("/"), name)
    if key not in _MEMO:
        _MEMO[key] = build()
    return _MEMO[key]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder; a local
    temporary folder only for a single-JVM session without that setting."""
    master = spark.sparkContext.master
    if not checkpoint_dir(spark) and master.startswith("local") and not master.startswith("local-cluster"):
        return os.path.join(tempfile.mkdtemp(prefix="aqarlens-"), name)
    return f"{own_folder(spark, 'scratch')}/{name}"


# ---------------------------------------------------------------- stages


def raw(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The raw listings, as a lazy view: each query reads the columns, and joins the tables, that it needs."""
    return listings_view(spark, sf_dir, columns)


def unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw listings, one row per listing: duplicates go before the columns are derived."""
    load = key_load(raw(spark, sf_dir, "listing_id"), "listing_id")
    return derived_listings(dedup_by_key(listing_sources(spark, sf_dir), "listing_id", SOURCE_TIES, load=load))


def cleaning(spark: SparkSession, sf_dir: str):
    def build():
        # Nothing reads the order of duplicates after the dedup, so it is not staged.
        return clean_property_data(raw(spark, sf_dir), deduped=unique(spark, sf_dir).drop(*TIE_COLUMNS))

    return _memo(spark, sf_dir, "cleaning", build)


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning(spark, sf_dir)[0]


def featured(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_listing_features(cleaned(spark, sf_dir))


def split_featured(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hash_split(featured(spark, sf_dir))


def encoding(spark: SparkSession, sf_dir: str) -> TargetEncodingModel:
    def build():
        rows = split_featured(spark, sf_dir).where((F.col("split") == "train") & (F.col("category") == "buy"))
        return fit_target_encoding(rows, ENC_COLUMNS, TARGET)

    return _memo(spark, sf_dir, "encoding", build)


def encoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature columns of every cleaned listing, staged: the model table and the summaries share them."""

    def build():
        rows = apply_target_encoding(split_featured(spark, sf_dir), encoding(spark, sf_dir))
        return materialize(rows.select("listing_id", "category", "split", *FEATURES, TARGET))

    return _memo(spark, sf_dir, "encoded", build)


def model_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Materialized once: every model fit and evaluation reads it again."""

    def build():
        return materialize(prepare_model_data(encoded(spark, sf_dir), keep=("listing_id", "split")))

    return _memo(spark, sf_dir, "model_table", build)


def _round(df: DataFrame, digits: int = 6, skip: tuple[str, ...] = ()) -> DataFrame:
    """Round every double column (engines sum/divide in different orders)."""
    return df.select(
        *[
            F.round(F.col(field.name), digits).alias(field.name)
            if field.dataType.simpleString() == "double" and field.name not in skip
            else F.col(field.name)
            for field in df.schema.fields
        ]
    )


def _sql_round(columns, digits: int = 6, doubles: set[str] | None = None) -> str:
    return ", ".join(
        f"round({name}, {digits}) AS {name}" if doubles is None or name in doubles else name for name in columns
    )


# ---------------------------------------------------------------- sources and projections


@register("drop_columns", sql.pipeline("listings") + "\nSELECT * EXCLUDE (contact_phone, agent_email) FROM listings")
def q_drop_columns(spark, sf_dir):
    return drop_irrelevant_columns(raw(spark, sf_dir))[0]


# CSV cannot tell an empty string from null: amenities '' reads back as null.
@register("csv_roundtrip", sql.pipeline("clean") + "\nSELECT * REPLACE (NULLIF(amenities, '') AS amenities) FROM clean")
def q_csv_roundtrip(spark, sf_dir):
    frame = cleaned(spark, sf_dir)
    path = scratch_path(spark, "csv_roundtrip")
    write_table(frame, path, fmt="csv")
    return read_listings(spark, path, fmt="csv", schema=frame.schema)


@register(
    "try_cast_numeric",
    sql.pipeline("listings")
    + "\nSELECT listing_id, TRY_CAST(price_egp AS DOUBLE) AS price_egp, TRY_CAST(area_value AS DOUBLE) AS area_value, "
    "TRY_CAST(bedrooms AS DOUBLE) AS bedrooms, TRY_CAST(bathrooms AS DOUBLE) AS bathrooms, "
    "TRY_CAST(images_count AS DOUBLE) AS images_count, TRY_CAST(lat AS DOUBLE) AS lat FROM listings",
)
def q_try_cast_numeric(spark, sf_dir):
    names = ("price_egp", "area_value", "bedrooms", "bathrooms", "images_count", "lat")
    return raw(spark, sf_dir, "listing_id", *names).select("listing_id", *[F.col(n).try_cast("double").alias(n) for n in names])


# ---------------------------------------------------------------- cleaning scalars


@register(
    "parse_rooms",
    sql.pipeline("listings")
    + f"\nSELECT listing_id, {sql._rooms('bedrooms', True)} AS bedrooms, {sql._rooms('bathrooms', False)} AS bathrooms FROM listings",
)
def q_parse_rooms(spark, sf_dir):
    df = raw(spark, sf_dir, "listing_id", "bedrooms", "bathrooms")
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.select(
        "listing_id",
        parse_room_count("bedrooms", types["bedrooms"], allow_studio=True).alias("bedrooms"),
        parse_room_count("bathrooms", types["bathrooms"], allow_studio=False).alias("bathrooms"),
    )


@register(
    "parse_amounts",
    sql.pipeline("listings")
    + f"\nSELECT listing_id, {sql._amount('price_egp')} AS price_egp, {sql._amount('area_value')} AS area_value, "
    f"{sql._amount('images_count')} AS images_count FROM listings",
)
def q_parse_amounts(spark, sf_dir):
    df = raw(spark, sf_dir, "listing_id", "price_egp", "area_value", "images_count")
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.select("listing_id", *[parse_amount(n, types[n]).alias(n) for n in ("price_egp", "area_value", "images_count")])


@register(
    "impute_median",
    sql.pipeline("medians")
    + ", modified AS (SELECT count_if(bedrooms IS NULL) + count_if(bathrooms IS NULL) + count_if(furnished IS NULL) AS m FROM parsed)"
    + "\nSELECT bed_med AS bedroom_median, bath_med AS bathroom_median, "
    "CAST((SELECT m FROM modified) AS BIGINT) AS rows_modified FROM medians",
)
def q_impute_median(spark, sf_dir):
    deduped = drop_irrelevant_columns(unique(spark, sf_dir))[0]
    _, bed, bath, modified = clean_numeric_columns(deduped)
    return spark.createDataFrame(
        [(float(bed), float(bath), int(modified))], "bedroom_median double, bathroom_median double, rows_modified long"
    )


@register(
    "fill_defaults",
    sql.pipeline("medians")
    + "\nSELECT p.listing_id, coalesce(p.bedrooms, (SELECT bed_med FROM medians)) AS bedrooms, "
    "coalesce(p.bathrooms, (SELECT bath_med FROM medians)) AS bathrooms, "
    "coalesce(p.images_count, 0.0E0) AS images_count, coalesce(p.furnished, 'NO') AS furnished, "
    "coalesce(p.completion_status, 'unknown') AS completion_status, coalesce(p.payment_method, 'unknown') AS payment_method "
    "FROM parsed p",
)
def q_fill_defaults(spark, sf_dir):
    deduped = drop_irrelevant_columns(unique(spark, sf_dir))[0]
    parsed = parse_listing_columns(deduped)
    bed, bath = fit_room_medians(parsed)
    return fill_defaults(parsed, bed, bath).select(
        "listing_id", "bedrooms", "bathrooms", "images_count", "furnished", "completion_status", "payment_method"
    )


@register(
    "payment_method",
    sql.pipeline("listings")
    + "\nSELECT listing_id, "
    + sql.payment_rule("lower(trim(coalesce(payment_method, '')))")
    + " AS payment_method FROM listings",
)
def q_payment_method(spark, sf_dir):
    return raw(spark, sf_dir, "listing_id", "payment_method").select("listing_id", payment_method_expr("payment_method").alias("payment_method"))


@register(
    "boolean_flags",
    sql.pipeline("listings")
    + "\nSELECT listing_id, "
    + ", ".join(f"{sql._flag(n)} AS {n}" for n in fx.BOOLEAN_FLAG_COLUMNS)
    + " FROM listings",
)
def q_boolean_flags(spark, sf_dir):
    return raw(spark, sf_dir, "listing_id", *fx.BOOLEAN_FLAG_COLUMNS).select("listing_id", *[flag_to_int(n).alias(n) for n in fx.BOOLEAN_FLAG_COLUMNS])


# ---------------------------------------------------------------- filters, dedup, funnel


@register(
    "dedup_listings",
    sql.pipeline("listings")
    + f"\nSELECT * EXCLUDE (__rn) FROM (SELECT *, row_number() OVER (PARTITION BY listing_id ORDER BY {sql.TIES}) AS __rn "
    "FROM listings) WHERE __rn = 1",
)
def q_dedup_listings(spark, sf_dir):
    return unique(spark, sf_dir)


@register(
    "critical_null_filter",
    sql.pipeline("survivors") + "\nSELECT listing_id, price_egp, area_value, lat, lon FROM survivors",
)
def q_critical_null_filter(spark, sf_dir):
    deduped = drop_irrelevant_columns(unique(spark, sf_dir))[0]
    parsed = parse_listing_columns(deduped)
    return parsed.where(critical_condition_for(parsed)).select("listing_id", "price_egp", "area_value", "lat", "lon")


@register(
    "outlier_trim",
    sql.pipeline("limits")
    + ", kept AS (SELECT s.price_per_sqm FROM survivors s WHERE s.price_per_sqm >= (SELECT lo FROM limits) "
    "AND s.price_per_sqm <= (SELECT hi FROM limits) "
    "AND s.area_value >= 20.0E0 AND s.area_value <= 1500.0E0)"
    "\nSELECT (SELECT lo FROM limits) AS low_limit, (SELECT hi FROM limits) AS high_limit, "
    "(SELECT count(*) FROM survivors) - (SELECT count(*) FROM kept) AS removed, "
    "(SELECT count(*) FROM kept) AS kept, (SELECT min(price_per_sqm) FROM kept) AS min_price_per_sqm, "
    "(SELECT max(price_per_sqm) FROM kept) AS max_price_per_sqm",
)
def q_outlier_trim(spark, sf_dir):
    _, report, model = cleaning(spark, sf_dir)
    return spark.createDataFrame(
        [
            (
                model.price_per_sqm_low,
                model.price_per_sqm_high,
                report.outliers_removed,
                report.final_rows,
                report.min_price_per_sqm,
                report.max_price_per_sqm,
            )
        ],
        "low_limit double, high_limit double, removed long, kept long, min_price_per_sqm double, max_price_per_sqm double",
    )


_REPORT_SQL = (
    sql.pipeline("clean_all")
    + ", dedup_all AS (SELECT DISTINCT listing_id FROM listings)"
    + "\nSELECT metric, value FROM (VALUES "
    "(1, 'initial_rows', (SELECT CAST(count(*) AS DOUBLE) FROM listings)), "
    "(2, 'final_rows', (SELECT CAST(count(*) AS DOUBLE) FROM clean_all)), "
    "(3, 'dropped_columns', 2.0E0), "
    "(4, 'duplicates_removed', (SELECT CAST(count(*) AS DOUBLE) FROM listings) - (SELECT CAST(count(*) AS DOUBLE) FROM dedup_all)), "
    "(5, 'critical_nulls_removed', (SELECT CAST(count(*) AS DOUBLE) FROM prepared) - (SELECT CAST(count(*) AS DOUBLE) FROM survivors)), "
    "(6, 'payment_rows_standardized_unknown', (SELECT CAST(count_if(payment_method = 'unknown') AS DOUBLE) FROM survivors)), "
    "(7, 'outliers_removed', (SELECT CAST(count(*) AS DOUBLE) FROM survivors) - (SELECT CAST(count(*) AS DOUBLE) FROM clean_all)), "
    "(8, 'bedroom_median', (SELECT bed_med FROM medians)), "
    "(9, 'bathroom_median', (SELECT bath_med FROM medians)), "
    "(10, 'min_price_per_sqm', (SELECT min(price_per_sqm) FROM clean_all)), "
    "(11, 'max_price_per_sqm', (SELECT max(price_per_sqm) FROM clean_all))"
    ") AS t(k, metric, value)"
)


@register("cleaning_report", _REPORT_SQL)
def q_cleaning_report(spark, sf_dir):
    report = cleaning(spark, sf_dir)[1]
    report.check()
    return report.to_frame(spark)


@register("clean_listings", sql.pipeline("clean") + "\nSELECT * FROM clean")
def q_clean_listings(spark, sf_dir):
    return cleaned(spark, sf_dir)


# ---------------------------------------------------------------- features


@register(
    "amenity_features",
    sql.pipeline("features")
    + "\nSELECT listing_id, amenity_count, "
    + ", ".join(name for _, name in fx.AMENITY_FEATURES)
    + " FROM features",
)
def q_amenity_features(spark, sf_dir):
    return featured(spark, sf_dir).select("listing_id", "amenity_count", *[name for _, name in fx.AMENITY_FEATURES])


@register("days_listed", sql.pipeline("features") + "\nSELECT listing_id, days_listed FROM features")
def q_days_listed(spark, sf_dir):
    return featured(spark, sf_dir).select("listing_id", "days_listed")


@register(
    "ratio_features",
    sql.pipeline("features")
    + "\nSELECT listing_id, bed_bath_ratio, total_rooms, round(area_per_room, 6) AS area_per_room, area_x_beds, "
    "round(log_area, 6) AS log_area FROM features",
)
def q_ratio_features(spark, sf_dir):
    return featured(spark, sf_dir).select(
        "listing_id",
        "bed_bath_ratio",
        "total_rooms",
        F.round("area_per_room", 6).alias("area_per_room"),
        "area_x_beds",
        F.round("log_area", 6).alias("log_area"),
    )


@register(
    "status_features",
    sql.pipeline("features") + "\nSELECT listing_id, is_furnished, completion_score, has_installments FROM features",
)
def q_status_features(spark, sf_dir):
    return featured(spark, sf_dir).select("listing_id", "is_furnished", "completion_score", "has_installments")


# ---------------------------------------------------------------- splits


@register(
    "hash_split",
    sql.pipeline("split_features") + "\nSELECT split, count(*) AS rows FROM split_features GROUP BY split",
)
def q_hash_split(spark, sf_dir):
    return split_featured(spark, sf_dir).groupBy("split").agg(F.count(F.lit(1)).alias("rows"))


@register(
    "union_splits",
    sql.pipeline("split_features") + "\nSELECT listing_id, split, category FROM split_features",
)
def q_union_splits(spark, sf_dir):
    frames = split_frames(split_featured(spark, sf_dir).select("listing_id", "category", "split"))
    return union_splits(frames, column="split")


# ---------------------------------------------------------------- target encoding


_ENC_ROUND = ", ".join(f"round({n}_enc, 4) AS {n}_enc" for n in ENC_COLUMNS)


@register(
    "target_encoding_fit",
    sql.pipeline("enc_map")
    + "\nSELECT column_name AS \"column\", value, round(mean, 4) AS mean, cnt AS count, round(encoded, 4) AS encoded FROM enc_map",
)
def q_target_encoding_fit(spark, sf_dir):
    return _round(encoding(spark, sf_dir).mapping, 4)


@register("encoding_roundtrip", ORACLES["target_encoding_fit"])
def q_encoding_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "encoding")
    encoding(spark, sf_dir).save(path)
    return _round(TargetEncodingModel.load(spark, path).mapping, 4)


@register(
    "target_encoding_apply",
    sql.pipeline("encoded") + f"\nSELECT listing_id, split, {_ENC_ROUND} FROM encoded",
)
def q_target_encoding_apply(spark, sf_dir):
    return _round(encoded(spark, sf_dir).select("listing_id", "split", *[f"{n}_enc" for n in ENC_COLUMNS]), 4)


_INSAMPLE_SQL = (
    sql.pipeline("features")
    + ", gm AS (SELECT avg(price_per_sqm) AS g FROM features), "
    + "enc_stats AS ("
    + " UNION ALL ".join(
        f"SELECT '{n}' AS column_name, CAST({n} AS VARCHAR) AS value, avg(price_per_sqm) AS mean, count(price_per_sqm) AS cnt "
        f"FROM features WHERE {n} IS NOT NULL GROUP BY 1, 2"
        for n in ENC_COLUMNS
    )
    + "), enc_map AS (SELECT column_name, value, coalesce((cnt * coalesce(mean, 0) + 10.0E0 * (SELECT g FROM gm)) "
    "/ (cnt + 10.0E0), (SELECT g FROM gm)) AS encoded FROM enc_stats), encoded AS (SELECT f.*, "
    + ", ".join(f"coalesce(e_{n}.encoded, (SELECT g FROM gm)) AS {n}_enc" for n in ENC_COLUMNS)
    + " FROM features f "
    + " ".join(
        f"LEFT JOIN enc_map e_{n} ON e_{n}.column_name = '{n}' AND e_{n}.value = CAST(f.{n} AS VARCHAR)" for n in ENC_COLUMNS
    )
    + ")"
)


@register("target_encoding_insample", _INSAMPLE_SQL + f"\nSELECT listing_id, {_ENC_ROUND} FROM encoded")
def q_target_encoding_insample(spark, sf_dir):
    out = add_target_encodings(featured(spark, sf_dir), ENC_COLUMNS, TARGET)
    return _round(out.select("listing_id", *[f"{n}_enc" for n in ENC_COLUMNS]), 4)


@register(
    "build_features",
    _INSAMPLE_SQL
    + "\nSELECT listing_id, "
    + ", ".join(
        (f"round({n}, 4) AS {n}" if n.endswith("_enc") else (n if n in INT_FEATURES else f"round({n}, 6) AS {n}"))
        for n in FEATURES
    )
    + " FROM encoded",
)
def q_build_features(spark, sf_dir):
    out = build_model_features(cleaned(spark, sf_dir), ENC_COLUMNS, TARGET).select("listing_id", *FEATURES)
    enc = [f"{n}_enc" for n in ENC_COLUMNS]
    return _round(_round(out, 4, skip=tuple(c for c in out.columns if c not in enc)), 6, skip=tuple(enc))


@register(
    "model_table",
    sql.pipeline("model_table")
    + "\nSELECT listing_id, split, "
    + _sql_round([*FEATURES, "price_per_sqm", "label"])
    + " FROM model_table",
)
def q_model_table(spark, sf_dir):
    return _round(model_table(spark, sf_dir))


@register(
    "expm1_inverse",
    sql.pipeline("model_table")
    + "\nSELECT listing_id, price_per_sqm, abs((exp(label) - 1) - price_per_sqm) <= 1.0E-6 * price_per_sqm AS recovered "
    "FROM model_table",
)
def q_expm1_inverse(spark, sf_dir):
    """``expm1(label)`` gives the target back (relative error ≤ 1e-6)."""
    table = model_table(spark, sf_dir)
    back = F.expm1("label")
    return table.select(
        "listing_id", TARGET, (F.abs(back - F.col(TARGET)) <= F.lit(1e-6) * F.col(TARGET)).alias("recovered")
    )


# ---------------------------------------------------------------- profiling and chart data


@register(
    "missing_values",
    sql.pipeline("clean")
    + "\nSELECT * FROM (VALUES "
    + ", ".join(f"('{n}', (SELECT CAST(count_if({n} IS NULL) AS BIGINT) FROM clean))" for n in CLEAN_COLUMNS)
    + ') AS t("column", missing_count)',
)
def q_missing_values(spark, sf_dir):
    return profiling.missing_values(cleaned(spark, sf_dir))


def _feature_summary_sql() -> str:
    parts = []
    for n in FEATURES:
        dtype = "int" if n in INT_FEATURES else "double"
        v = f"CAST({n} AS DOUBLE)"
        parts.append(
            f"SELECT '{n}' AS feature, '{dtype}' AS dtype, count({n}) AS non_null, round(min({v}), 4) AS \"min\", "
            f"round(max({v}), 4) AS \"max\", round(avg({v}), 4) AS mean FROM encoded"
        )
    return sql.pipeline("encoded") + "\n" + " UNION ALL ".join(parts)


@register("feature_summary", _feature_summary_sql())
def q_feature_summary(spark, sf_dir):
    return _round(profiling.feature_summary(encoded(spark, sf_dir), FEATURES), 4)


@register(
    "category_shares",
    sql.pipeline("listings")
    + "\nSELECT category, count(*) AS count, round(count(*) / (SELECT CAST(count(*) AS DOUBLE) FROM listings), 6) AS share "
    "FROM listings GROUP BY category",
)
def q_category_shares(spark, sf_dir):
    return profiling.category_shares(raw(spark, sf_dir, "category"), "category").withColumn("share", F.round("share", 6))


@register(
    "top_property_types",
    sql.pipeline("listings")
    + "\nSELECT property_type, count(*) AS count FROM listings GROUP BY property_type "
    "ORDER BY count DESC, property_type ASC NULLS LAST LIMIT 8",
)
def q_top_property_types(spark, sf_dir):
    return profiling.top_k_counts(raw(spark, sf_dir, "property_type"), "property_type", 8)


def _histogram_sql(source: str, value: str, segment_sql: str, bins: int = 60) -> str:
    return (
        f", seg AS (SELECT {segment_sql} AS segment, {value} AS x FROM {source}), "
        "segx AS (SELECT * FROM seg WHERE x IS NOT NULL AND segment IS NOT NULL), "
        "b AS (SELECT segment, min(x) AS lo, max(x) AS hi FROM segx GROUP BY segment), "
        "binned AS (SELECT s.segment, CASE WHEN b.hi > b.lo THEN CAST(least(floor((s.x - b.lo) / ((b.hi - b.lo) / "
        f"{bins})), {bins - 1}) AS INTEGER) ELSE 0 END AS bin, b.lo, (b.hi - b.lo) / {bins} AS w "
        "FROM segx s JOIN b ON s.segment = b.segment)"
        "\nSELECT segment, bin, round(lo + bin * w, 6) AS bin_low, round(lo + (bin + 1) * w, 6) AS bin_high, count(*) AS count "
        "FROM binned GROUP BY segment, bin, lo, w"
    )


@register(
    "price_histogram",
    sql.pipeline("clean")
    + _histogram_sql(
        "clean",
        "CASE WHEN category = 'buy' AND price_egp < 50000000 THEN price_egp / 1000000.0E0 "
        "WHEN category = 'rent' AND price_egp < 500000 THEN price_egp / 1000.0E0 END",
        "category",
    ),
)
def q_price_histogram(spark, sf_dir):
    price = F.col("price_egp").try_cast("double")
    hist = profiling.segment_histograms(
        cleaned(spark, sf_dir),
        price,
        "category",
        {"buy": (price < 50_000_000, 1_000_000.0), "rent": (price < 500_000, 1_000.0)},
    )
    return hist.withColumn("bin_low", F.round("bin_low", 6)).withColumn("bin_high", F.round("bin_high", 6))


@register(
    "target_histogram",
    sql.pipeline("model_table") + _histogram_sql("model_table", "price_per_sqm", "'all'"),
)
def q_target_histogram(spark, sf_dir):
    table = model_table(spark, sf_dir).withColumn("segment", F.lit("all"))
    hist = profiling.segment_histograms(table, F.col(TARGET), "segment", {"all": (F.lit(True), 1.0)})
    return hist.withColumn("bin_low", F.round("bin_low", 6)).withColumn("bin_high", F.round("bin_high", 6))


@register(
    "price_area_trend",
    sql.pipeline("clean")
    + ", seg AS (SELECT CASE WHEN category = 'buy' AND price_egp < 50000000 AND area_value < 1000 THEN 'buy' "
    "WHEN category = 'rent' AND price_egp < 100000 AND area_value < 500 THEN 'rent' END AS segment, "
    "area_value AS x, price_egp AS y FROM clean)"
    "\nSELECT segment, count(*) AS n, round(regr_slope(y, x), 3) AS slope, round(regr_intercept(y, x), 1) AS intercept, "
    "min(x) AS min_x, max(x) AS max_x FROM seg WHERE segment IS NOT NULL GROUP BY segment",
)
def q_price_area_trend(spark, sf_dir):
    trend = _price_area_trend(spark, sf_dir)
    return trend.withColumn("slope", F.round("slope", 3)).withColumn("intercept", F.round("intercept", 1))


_TREND_SEGMENTS_SQL = (
    ", seg AS (SELECT CASE WHEN category = 'buy' AND price_egp < 50000000 AND area_value < 1000 THEN 'buy' "
    "WHEN category = 'rent' AND price_egp < 100000 AND area_value < 500 THEN 'rent' END AS segment, "
    "area_value AS x, price_egp AS y FROM clean)"
)


def _price_area_trend(spark, sf_dir) -> DataFrame:
    price, area = F.col("price_egp"), F.col("area_value")
    return profiling.linear_trend(
        cleaned(spark, sf_dir),
        "area_value",
        "price_egp",
        "category",
        {"buy": (price < 50_000_000) & (area < 1_000), "rent": (price < 100_000) & (area < 500)},
    )


@register(
    "price_area_trend_line",
    sql.pipeline("clean")
    + _TREND_SEGMENTS_SQL
    + ", fit AS (SELECT segment, regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept, min(x) AS min_x, "
    "max(x) AS max_x FROM seg WHERE segment IS NOT NULL GROUP BY segment HAVING regr_slope(y, x) IS NOT NULL)"
    + ", spans AS (SELECT *, unnest(range(0, 100)) AS i FROM fit)"
    "\nSELECT segment, CAST(i AS INTEGER) AS point, round(min_x + (max_x - min_x) * i / 99.0E0, 6) AS x, "
    "round(slope * (min_x + (max_x - min_x) * i / 99.0E0) + intercept, 1) AS y FROM spans",
)
def q_price_area_trend_line(spark, sf_dir):
    """The 100-point least-squares line drawn over each segment's scatter."""
    points = profiling.trend_line_points(_price_area_trend(spark, sf_dir), 100)
    return points.select("segment", "point", F.round("x", 6).alias("x"), F.round("y", 1).alias("y"))


@register(
    "feature_correlations",
    sql.pipeline("model_table")
    + "\n"
    + " UNION ALL ".join(
        f"SELECT '{n}' AS feature, round(corr({n}, price_per_sqm), 6) AS pearson_r FROM model_table" for n in FEATURES
    ),
)
def q_feature_correlations(spark, sf_dir):
    corr = profiling.feature_correlations(model_table(spark, sf_dir), FEATURES, TARGET)
    return corr.withColumn("pearson_r", F.round("pearson_r", 6))


@register(
    "correlation_matrix",
    sql.pipeline("clean")
    + ", cc AS (SELECT "
    + ", ".join(f"TRY_CAST({n} AS DOUBLE) AS {n}" for n in CORRELATION_COLUMNS)
    + " FROM clean WHERE "
    + " AND ".join(f"TRY_CAST({n} AS DOUBLE) IS NOT NULL" for n in CORRELATION_COLUMNS)
    + ")\n"
    + " UNION ALL ".join(
        f"SELECT '{CORRELATION_COLUMNS[i]}' AS row_feature, '{CORRELATION_COLUMNS[j]}' AS col_feature, "
        f"round(corr({CORRELATION_COLUMNS[i]}, {CORRELATION_COLUMNS[j]}), 6) AS pearson_r FROM cc"
        for i in range(len(CORRELATION_COLUMNS))
        for j in range(i)
    ),
)
def q_correlation_matrix(spark, sf_dir):
    matrix = profiling.correlation_matrix(cleaned(spark, sf_dir), CORRELATION_COLUMNS)
    return matrix.withColumn("pearson_r", F.round("pearson_r", 6))


@register(
    "quantiles_exact",
    sql.pipeline("clean")
    + "\n"
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST({p} AS DOUBLE) AS probability, CAST(quantile_disc({c}, {p}) AS DOUBLE) AS value FROM clean"
        for c in QUANTILE_COLUMNS
        for p in QUANTILE_PROBS
    ),
)
def q_quantiles_exact(spark, sf_dir):
    return quantile_table(cleaned(spark, sf_dir), QUANTILE_COLUMNS, QUANTILE_PROBS, method="exact")


@register("quantiles_exact_rounds", ORACLES["quantiles_exact"])
def q_quantiles_exact_rounds(spark, sf_dir):
    """The same values by the narrowing rounds that large tables take."""
    wanted = {c: list(QUANTILE_PROBS) for c in QUANTILE_COLUMNS}
    found = exact_quantiles_multi(cleaned(spark, sf_dir), wanted, buckets=16, final_rows=50)
    rows = [(c, float(p), v) for c in QUANTILE_COLUMNS for p, v in zip(QUANTILE_PROBS, found[c], strict=True)]
    return spark.createDataFrame(rows, '"column" string, probability double, value double'.replace('"', "`"))


@register(
    "quantiles_approx",
    "SELECT * FROM (VALUES "
    + ", ".join(f"('{c}', CAST({p} AS DOUBLE), true)" for c in QUANTILE_COLUMNS for p in QUANTILE_PROBS)
    + ') AS t("column", probability, within)',
)
def q_quantiles_approx(spark, sf_dir):
    """Whether each approximate quantile's rank is within 0.01 of the one asked for."""
    table = cleaned(spark, sf_dir)
    found = quantile_table(table, QUANTILE_COLUMNS, QUANTILE_PROBS, method="approx").collect()
    counts = []
    for i, r in enumerate(found):
        value = F.col(r["column"])
        counts += [
            F.count_if(value < r["value"]).alias(f"below{i}"),
            F.count_if(value <= r["value"]).alias(f"upto{i}"),
            F.count(value).alias(f"n{i}"),
        ]
    ranks = table.agg(*counts).first()
    rows = []
    for i, r in enumerate(found):
        slack = 0.01 * ranks[f"n{i}"] + 1
        rank = r["probability"] * ranks[f"n{i}"]
        rows.append((r["column"], r["probability"], ranks[f"below{i}"] - slack <= rank <= ranks[f"upto{i}"] + slack))
    return spark.createDataFrame(rows, "`column` string, probability double, within boolean")


@register(
    "quantiles_by_city",
    sql.pipeline("clean")
    + "\nSELECT city, CAST(p AS DOUBLE) AS probability, count(price_per_sqm) AS n, true AS within FROM clean, "
    + f"(SELECT unnest([{', '.join(map(str, QUANTILE_PROBS))}]) AS p) GROUP BY city, p",
)
def q_quantiles_by_city(spark, sf_dir):
    """Sketched quantiles of every city, and whether their ranks among the city's rows are within 0.01."""
    table = cleaned(spark, sf_dir).select("city", TARGET)
    found = sketch_quantiles(table, TARGET, QUANTILE_PROBS, ("city",))
    joined = table.join(F.broadcast(found.withColumnRenamed("city", "of")), F.col("city").eqNullSafe(F.col("of")))
    ranks = joined.groupBy("city", "probability", "value").agg(
        F.count(TARGET).alias("n"), F.count_if(F.col(TARGET) < F.col("value")).alias("below"), F.count_if(F.col(TARGET) <= F.col("value")).alias("upto")
    )
    rank, slack = F.col("probability") * F.col("n"), 0.01 * F.col("n") + 1
    within = (F.col("below") - slack <= rank) & (rank <= F.col("upto") + slack)
    return ranks.select("city", "probability", "n", within.alias("within"))


# Every 97th listing has text where a number should be, every 101st too few fields.
_DAMAGE = "CASE WHEN listing_id % 101 = 0 THEN 2 WHEN listing_id % 97 = 0 THEN 1 ELSE 0 END"


@register(
    "csv_checked",
    sql.pipeline("clean")
    + "\nSELECT listing_id, CASE d WHEN 0 THEN round(price_egp, 2) END AS price_egp, CASE d WHEN 0 THEN city END AS city, "
    "CASE d WHEN 1 THEN 'price_egp' WHEN 2 THEN 'fields' END AS reason, 'listing_id bigint,city string,price_egp double' AS found FROM "
    f"(SELECT *, {_DAMAGE} AS d FROM clean)",
)
def q_csv_checked(spark, sf_dir):
    """A headerless CSV with damaged records: typed good rows, bad rows with the reason, the inferred schema."""
    damage = F.expr(_DAMAGE)
    listing, price = F.col("listing_id").cast("string"), F.format_string("%.2f", "price_egp")
    whole = F.concat_ws(",", listing, F.col("city"), F.when(damage == 1, F.lit("unknown")).otherwise(price))
    path = scratch_path(spark, "csv_checked")
    cleaned(spark, sf_dir).select(F.when(damage == 2, listing).otherwise(whole).alias("value")).write.text(path)
    read = read_checked(spark, path, columns=("listing_id", "city", "price_egp"))
    found = ",".join(f"{f.name} {f.dataType.simpleString()}" for f in read.schema.fields)
    good = read.good.select("listing_id", F.round("price_egp", 2).alias("price_egp"), "city", F.lit(None).cast("string").alias("reason"))
    empty = [F.lit(None).cast(t).alias(n) for n, t in (("price_egp", "double"), ("city", "string"))]
    bad = read.bad.select(F.expr("cast(split(record, ',')[0] as long)").alias("listing_id"), *empty, "reason")
    return good.unionByName(bad).withColumn("found", F.lit(found))


# ---------------------------------------------------------------- flagship


@register(
    "city_price_summary",
    sql.pipeline("encoded")
    + "\nSELECT category, city, count(*) AS listings, round(avg(price_per_sqm), 4) AS avg_price_per_sqm, "
    "min(price_per_sqm) AS min_price_per_sqm, max(price_per_sqm) AS max_price_per_sqm, "
    "round(avg(city_enc), 4) AS city_enc FROM encoded GROUP BY category, city",
)
def q_city_price_summary(spark, sf_dir):
    """Clean → features → split → encoding (train ∧ buy) → per category and city.

    Only the city encoding is joined: an outer join cannot be pruned by the
    optimizer, so unused encodings are not applied at all."""
    rows = apply_target_encoding(split_featured(spark, sf_dir), encoding(spark, sf_dir), columns=("city",))
    return rows.groupBy("category", "city").agg(
        F.count(F.lit(1)).alias("listings"),
        F.round(F.avg(TARGET), 4).alias("avg_price_per_sqm"),
        F.min(TARGET).alias("min_price_per_sqm"),
        F.max(TARGET).alias("max_price_per_sqm"),
        F.round(F.avg("city_enc"), 4).alias("city_enc"),
    )


# ---------------------------------------------------------------- evaluation (SQL-checkable baseline)

from aqarlens.operators.splits import map_sample, random_split, segment_sample  # noqa: E402
from aqarlens.plans.config import DEFAULT_MODEL_PARAMS  # noqa: E402
from aqarlens.plans.evaluation import (  # noqa: E402
    feature_importance,
    group_mean_baseline,
    metrics_by_split,
    regression_metrics,
    residuals,
)
from aqarlens.plans.scoring import ModelBundle, predict_price_per_sqm  # noqa: E402
from aqarlens.plans import reports  # noqa: E402
from aqarlens.plans.training import RESULT_FIELDS, fit_model, model_specs, train_models, tuning_table  # noqa: E402
from aqarlens.plans.trees import node_table  # noqa: E402
from aqarlens.operators.moments import ridge  # noqa: E402
from aqarlens.operators.split_gains import boosted_stumps, split_gains  # noqa: E402
from aqarlens.catalog import model_sql as msql  # noqa: E402
from pyspark.ml.tuning import ParamGridBuilder  # noqa: E402

BASELINE_KEY = "completion_score"
_BASELINE_SQL = (
    sql.pipeline("model_table")
    + f", base AS (SELECT {BASELINE_KEY}, avg(label) AS gmean FROM model_table WHERE split = 'train' GROUP BY {BASELINE_KEY}), "
    "overall AS (SELECT avg(label) AS m FROM model_table WHERE split = 'train'), "
    "scored AS (SELECT t.*, coalesce(b.gmean, (SELECT m FROM overall)) AS prediction FROM model_table t "
    f"LEFT JOIN base b ON t.{BASELINE_KEY} = b.{BASELINE_KEY})"
)
_METRICS_SQL = (
    "count(*) AS n, round(1 - sum((label - prediction) * (label - prediction)) / (var_pop(label) * count(*)), 6) AS r2, "
    "round(sqrt(avg((label - prediction) * (label - prediction))), 6) AS rmse_log, "
    "round(avg(abs(label - prediction)), 6) AS mae_log, "
    "round(sqrt(avg(((exp(label) - 1) - (exp(prediction) - 1)) * ((exp(label) - 1) - (exp(prediction) - 1)))), 4) AS rmse_units"
)


def _round_metrics(df: DataFrame) -> DataFrame:
    return df.select(
        *[c for c in df.columns if c not in ("r2", "rmse_log", "mae_log", "rmse_units")],
        F.round("r2", 6).alias("r2"),
        F.round("rmse_log", 6).alias("rmse_log"),
        F.round("mae_log", 6).alias("mae_log"),
        F.round("rmse_units", 4).alias("rmse_units"),
    )


def baseline_scored(spark, sf_dir) -> DataFrame:
    return group_mean_baseline(model_table(spark, sf_dir), BASELINE_KEY)


@register("metrics_by_split", _BASELINE_SQL + f"\nSELECT split, {_METRICS_SQL} FROM scored GROUP BY split")
def q_metrics_by_split(spark, sf_dir):
    return _round_metrics(metrics_by_split(baseline_scored(spark, sf_dir)))


@register("regression_metrics", _BASELINE_SQL + f"\nSELECT {_METRICS_SQL} FROM scored WHERE split = 'test'")
def q_regression_metrics(spark, sf_dir):
    return _round_metrics(regression_metrics(baseline_scored(spark, sf_dir).where(F.col("split") == "test")))


@register(
    "residuals",
    _BASELINE_SQL
    + "\nSELECT listing_id, split, round(exp(prediction) - 1, 4) AS predicted_units, "
    "round((exp(label) - 1) - (exp(prediction) - 1), 4) AS residual FROM scored",
)
def q_residuals(spark, sf_dir):
    out = residuals(baseline_scored(spark, sf_dir), keep=("listing_id", "split"))
    return out.select(
        "listing_id", "split", F.round("predicted_units", 4).alias("predicted_units"), F.round("residual", 4).alias("residual")
    )


@register(
    "linear_trend_fit",
    sql.pipeline("model_table")
    + "\nSELECT round(regr_slope(label, log_area), 6) AS coefficient, round(regr_intercept(label, log_area), 6) AS intercept "
    "FROM model_table WHERE split = 'train'",
)
def q_linear_trend_fit(spark, sf_dir):
    """One-feature, unpenalised LinearRegression = least squares line."""
    from pyspark.ml.regression import LinearRegression

    train = model_table(spark, sf_dir).where(F.col("split") == "train")
    estimator = LinearRegression(featuresCol="features", labelCol="label", regParam=0.0, elasticNetParam=0.0, solver="normal")
    fitted, _ = fit_model(estimator, [], train, ["log_area"])
    lr = fitted.stages[-1]
    return spark.createDataFrame(
        [(round(float(lr.coefficients[0]), 6), round(float(lr.intercept), 6))], "coefficient double, intercept double"
    )


# ---------------------------------------------------------------- model fits


def _spec(key: str, params=None):
    names = {"linear_regression": 0, "decision_tree": 1, "random_forest": 2, "gbt": 3}
    params = dict(params or DEFAULT_MODEL_PARAMS)
    block = dict(params.get(key, {}))
    block["enabled"] = True
    only = {k: {"enabled": False} for k in names}
    only[key] = block
    only["tuning"] = params.get("tuning", {})
    return model_specs(only)[0]


def fitted_model(spark, sf_dir, key: str):
    def build():
        name, estimator, grid = _spec(key)
        train = model_table(spark, sf_dir).where(F.col("split") == "train")
        return fit_model(estimator, grid, train)[0]

    return _memo(spark, sf_dir, f"fit:{key}", build)


#: Features with few values, whose every threshold a tree tries, and two that a ridge line in SQL can take.
TREE_FEATURES = ("bedrooms", "bathrooms", "total_rooms", "images_count", "completion_score", "amenity_count", "is_furnished")
LINE_FEATURES = ("total_rooms", "images_count")
MIN_ROWS = 20
PENALTY = 0.1


def fitted_on(spark, sf_dir, key: str, features, **options):
    """A model fitted on the training rows with the roster's estimator of ``key`` and these options."""
    _, estimator, grid = _spec(key, {key: {"estimator": options}})
    train = model_table(spark, sf_dir).where(F.col("split") == "train")
    return fit_model(estimator, grid, train, features)[0]


def _nodes(spark, model, features, *keep) -> DataFrame:
    name = F.when(F.col("feature").isNotNull(), F.element_at(F.array(*[F.lit(n) for n in features]), F.col("feature") + 1))
    return _round(node_table(spark, model).select(*keep, "node", name.alias("feature"), "threshold", "gain", "prediction"))


_FEATURE_NAMES = "[" + ", ".join(f"'{n}'" for n in TREE_FEATURES) + "]"
_TREE_SQL = msql.rows(TREE_FEATURES) + msql.tree("dt", len(TREE_FEATURES), MIN_ROWS)
_NODES_SQL = (
    f"CAST(node AS BIGINT) AS node, {_FEATURE_NAMES}[k + 1] AS feature, round(threshold, 6) AS threshold, "
    "round(gain, 6) AS gain, round(mean, 6) AS prediction FROM dt_nodes"
)


@register("fit_tree", _TREE_SQL + "\nSELECT " + _NODES_SQL)
def q_fit_tree(spark, sf_dir):
    """The nodes of a tree of depth two: every split, gain and mean."""
    model = fitted_on(spark, sf_dir, "decision_tree", TREE_FEATURES, maxDepth=2, minInstancesPerNode=MIN_ROWS)
    return _nodes(spark, model, TREE_FEATURES)


@register("fit_forest", _TREE_SQL + ", trees AS (SELECT CAST(unnest(range(3)) AS INTEGER) AS tree)\nSELECT tree, " + _NODES_SQL + ", trees")
def q_fit_forest(spark, sf_dir):
    """Without bootstrap and with all features at every node, each tree of a forest is the one tree."""
    options = {"numTrees": 3, "bootstrap": False, "featureSubsetStrategy": "all", "maxDepth": 2, "minInstancesPerNode": MIN_ROWS}
    return _nodes(spark, fitted_on(spark, sf_dir, "random_forest", TREE_FEATURES, **options), TREE_FEATURES, "tree")


@register(
    "tree_split_gains",
    msql.rows(TREE_FEATURES)
    + msql.split("one", "tr", len(TREE_FEATURES), MIN_ROWS)
    + f"\nSELECT {_FEATURE_NAMES}[k + 1] AS feature, (value + after) / 2 AS threshold, CAST(n AS BIGINT) AS n, CAST(nl AS BIGINT) AS n_left, "
    "round(sl / nl, 6) AS left_mean, round((s - sl) / (n - nl), 6) AS right_mean, round((q / n - (s / n) ** 2) - (nl / n) * (ql / nl - (sl / nl) ** 2) "
    f"- ((n - nl) / n) * ((q - ql) / (n - nl) - ((s - sl) / (n - nl)) ** 2), 6) AS gain FROM one_r WHERE after IS NOT NULL AND nl >= {MIN_ROWS} AND n - nl >= {MIN_ROWS}",
)
def q_tree_split_gains(spark, sf_dir):
    """The gain of every threshold of every feature at a tree's root, as a table."""
    train = model_table(spark, sf_dir).where(F.col("split") == "train")
    gains = split_gains(train, TREE_FEATURES, F.col("label"), MIN_ROWS)
    name = F.element_at(F.array(*[F.lit(n) for n in TREE_FEATURES]), F.col("feature") + 1)
    return _round(gains.withColumn("feature", name))


_BOOSTED_SQL = (
    msql.rows(TREE_FEATURES)
    + msql.boosted("gb", len(TREE_FEATURES))
    + f"\nSELECT listing_id, split, round({msql.stump_value('gb1')} + 0.1E0 * {msql.stump_value('gb2')}, 6) AS prediction FROM m"
)


@register("fit_gbt", _BOOSTED_SQL)
def q_fit_gbt(spark, sf_dir):
    """Two boosted rounds of depth one at step 0.1: the prediction of every row."""
    model = fitted_on(spark, sf_dir, "gbt", TREE_FEATURES, maxIter=2, maxDepth=1, stepSize=0.1)
    return _round(model.transform(model_table(spark, sf_dir)).select("listing_id", "split", "prediction"))


@register("boosted_stumps", _BOOSTED_SQL)
def q_boosted_stumps(spark, sf_dir):
    """The same from split tables, round by round."""
    table = model_table(spark, sf_dir)
    prediction, _ = boosted_stumps(table.where(F.col("split") == "train"), TREE_FEATURES, "label", rounds=2, step=0.1)
    return _round(table.select("listing_id", "split", prediction.alias("prediction")))


_LINE_SQL = msql.rows(LINE_FEATURES) + msql.line("lr", "tr", PENALTY)
_LINE_COLUMNS = "round(w1, 6) AS total_rooms, round(w2, 6) AS images_count, round(b, 6) AS intercept"


@register(
    "fit_linear",
    _LINE_SQL
    + ", scored AS (SELECT split, y, w1 * x[1] + w2 * x[2] + b AS p, w1, w2, b FROM m, lr)"
    + "\nSELECT split, count(*) AS n, "
    + ", ".join(f"round({msql.METRICS[m]}, {msql.DIGITS[m]}) AS {c}" for m, c in (("R2", "r2"), ("RMSE_log", "rmse_log"), ("MAE_log", "mae_log"), ("RMSE_EGP", "rmse_units")))
    + f", {_LINE_COLUMNS} FROM scored GROUP BY split, w1, w2, b",
)
def q_fit_linear(spark, sf_dir):
    """The shipped ridge regression on two features: coefficients, and metrics of every split."""
    model = fitted_on(spark, sf_dir, "linear_regression", LINE_FEATURES, maxIter=50, regParam=PENALTY, elasticNetParam=0.0)
    scored = metrics_by_split(model.transform(model_table(spark, sf_dir)))
    line = model.stages[-1]
    found = dict(zip(LINE_FEATURES, line.coefficients.toArray().tolist(), strict=True), intercept=line.intercept)
    return _round(_round(scored, 3, skip=("r2", "rmse_log", "mae_log")).withColumns({k: F.lit(float(v)) for k, v in found.items()}))


@register("ridge_equations", _LINE_SQL + f"\nSELECT {_LINE_COLUMNS} FROM lr")
def q_ridge_equations(spark, sf_dir):
    """The same line from the normal equations of one aggregate."""
    train = model_table(spark, sf_dir).where(F.col("split") == "train")
    weights, intercept = ridge(train, LINE_FEATURES, "label", PENALTY)
    row = [tuple(round(float(v), 6) for v in (*weights, intercept))]
    return spark.createDataFrame(row, "total_rooms double, images_count double, intercept double")


def _tuned_line(spark, sf_dir, tuning) -> list[tuple[dict, float]]:
    """Least squares of one feature with and without an intercept, by a tuner."""
    from pyspark.ml.regression import LinearRegression
    from pyspark.ml.tuning import ParamGridBuilder

    estimator = LinearRegression(featuresCol="features", labelCol="label", regParam=0.0, solver="normal")
    grid = ParamGridBuilder().addGrid(estimator.fitIntercept, [True, False]).build()
    train = model_table(spark, sf_dir).where(F.col("split") == "train")
    fold = F.expr("(instr('0123456789abcdef', substr(md5(cast(listing_id as string)), 9, 1)) - 1) % 3")
    train = train.withColumn("fold", fold.cast("int"))
    _, tuned = fit_model(estimator, grid, train, ["log_area"], {"parallelism": 1, **tuning})
    return tuning_table(tuned)


_VALIDATES = "instr('0123456789abc', substr(md5(cast(listing_id as string)), 9, 1)) between 1 and 3"


@register(
    "tune_tvs",
    msql.rows(LINE_FEATURES)
    + f", fitted AS (SELECT * FROM tr WHERE NOT ({_VALIDATES})), held AS (SELECT * FROM tr WHERE {_VALIDATES})"
    + "".join(msql.line(f"line{k}", "fitted", p) + msql.line(f"all{k}", "tr", p) for k, p in enumerate((0.1, 0.0, 1.0)))
    + ", tried AS ("
    + " UNION ALL ".join(
        f"SELECT CAST({p} AS DOUBLE) AS reg_param, (SELECT {msql.METRICS['R2']} FROM (SELECT y, w1 * x[1] + w2 * x[2] + b AS p FROM held, line{k})) AS r2, "
        f"all{k}.* FROM all{k}"
        for k, p in enumerate((0.1, 0.0, 1.0))
    )
    + ")\nSELECT reg_param, round(r2, 6) AS validation_r2, r2 = max(r2) OVER () AS chosen, "
    "CASE WHEN r2 = max(r2) OVER () THEN round(b, 6) END AS refitted_intercept FROM tried",
)
def q_tune_tvs(spark, sf_dir):
    """The shipped ridge regression and two other penalties, validated on rows that a hash names."""
    _, estimator, _ = _spec("linear_regression")
    grid = ParamGridBuilder().addGrid(estimator.regParam, [0.1, 0.0, 1.0]).build()
    train = model_table(spark, sf_dir).where(F.col("split") == "train").withColumn("held", F.expr(_VALIDATES))
    tuning = {"method": "train_validation_split", "validation_col": "held"}
    model, tuned = fit_model(estimator, grid, train, LINE_FEATURES, tuning)
    tried = tuning_table(tuned)
    intercept = round(model.stages[-1].intercept, 6)
    rows = [(chosen["regParam"], round(score, 6), k == 0, intercept if k == 0 else None) for k, (chosen, score) in enumerate(tried)]
    return spark.createDataFrame(rows, "reg_param double, validation_r2 double, chosen boolean, refitted_intercept double")


@register(
    "tune_cv",
    sql.pipeline("model_table")
    + ", t AS (SELECT log_area AS x, label AS y, (instr('0123456789abcdef', substr(md5(CAST(listing_id AS VARCHAR)), 9, 1)) - 1) % 3 AS f "
    "FROM model_table WHERE split = 'train'), folds AS (SELECT unnest(range(0, 3)) AS k), "
    "fit AS (SELECT k, regr_slope(y, x) AS a, regr_intercept(y, x) AS b, sum(x * y) / sum(x * x) AS a0 "
    "FROM folds, t WHERE f <> k GROUP BY k), "
    "score AS (SELECT k, 1 - sum((y - a * x - b) * (y - a * x - b)) / (var_pop(y) * count(*)) AS r2, "
    "1 - sum((y - a0 * x) * (y - a0 * x)) / (var_pop(y) * count(*)) AS r20 FROM t JOIN fit ON f = k GROUP BY k) "
    "\nSELECT true AS fit_intercept, round(avg(r2), 6) AS mean_r2 FROM score "
    "UNION ALL SELECT false, round(avg(r20), 6) FROM score",
)
def q_tune_cv(spark, sf_dir):
    """Three folds by a hash of the listing, through the tuner's fold column."""
    tried = _tuned_line(spark, sf_dir, {"method": "cross_validator", "num_folds": 3, "fold_col": "fold"})
    rows = [(bool(chosen["fitIntercept"]), round(score, 6)) for chosen, score in tried]
    return spark.createDataFrame(rows, "fit_intercept boolean, mean_r2 double")


#: Four models whose every number SQL can compute: the shipped line, and trees on two features.
COMPARED_PARAMS = {
    "linear_regression": DEFAULT_MODEL_PARAMS["linear_regression"],
    "decision_tree": {"param_grid": {"maxDepth": [2], "minInstancesPerNode": [MIN_ROWS]}},
    "random_forest": {
        "estimator": {"bootstrap": False},
        "param_grid": {"numTrees": [3], "maxDepth": [1], "minInstancesPerNode": [MIN_ROWS], "featureSubsetStrategy": ["all"]},
    },
    "gbt": {"param_grid": {"maxIter": [2], "maxDepth": [1], "stepSize": [0.1]}},
}


def _comparison(spark, sf_dir):
    """The trained models' results, best first, fitted once per session."""

    def build():
        return train_models(model_table(spark, sf_dir), COMPARED_PARAMS, LINE_FEATURES, select_on="test", materialize_mode="none")

    return _memo(spark, sf_dir, "comparison", build)[0]


def _metrics(rows: DataFrame) -> DataFrame:
    """Metrics to as many digits as their SQL."""
    digits = {c: msql.DIGITS[m] for c in rows.columns for m in msql.METRICS if c == m or c.endswith(f"_{m}")}
    return rows.select(*[F.round(c, digits[c]).alias(c) if c in digits else F.col(c) for c in rows.columns])


_COMPARED_SQL = msql.rows(LINE_FEATURES) + msql.compared(MIN_ROWS, PENALTY)


@register("model_comparison", _COMPARED_SQL + f"SELECT {', '.join(RESULT_FIELDS)} FROM compared")
def q_model_comparison(spark, sf_dir):
    """All fifteen result columns of every model."""
    return _metrics(_comparison(spark, sf_dir))


@register("holdout_table", _COMPARED_SQL + "SELECT Model, R2, RMSE_log, MAE_log, RMSE_EGP FROM compared")
def q_holdout_table(spark, sf_dir):
    return _metrics(reports.holdout_table(_comparison(spark, sf_dir)))


@register("split_table", _COMPARED_SQL + "SELECT Model, Train_R2, Validation_R2, R2, RMSE_EGP FROM compared")
def q_split_table(spark, sf_dir):
    return _metrics(reports.split_table(_comparison(spark, sf_dir)))


@register("model_comparison_chart", _COMPARED_SQL + "SELECT Model, R2, RMSE_EGP FROM compared")
def q_model_comparison_chart(spark, sf_dir):
    return _metrics(reports.model_comparison_chart(_comparison(spark, sf_dir)))


@register(
    "empty_check",
    sql.pipeline("clean") + "\nSELECT count(*) AS listings, true AS refused FROM clean",
)
def q_empty_check(spark, sf_dir):
    """A category without rows is refused before any model sees it."""
    rows = encoded(spark, sf_dir)
    try:
        prepare_model_data(rows, category="no such category")
        refused = False
    except ValueError:
        refused = True
    return rows.agg(F.count(F.lit(1)).alias("listings")).withColumn("refused", F.lit(refused))


@register(
    "feature_importance",
    _TREE_SQL
    + f", per AS (SELECT k, sum(gain * n) AS g FROM dt_inner GROUP BY k), names AS (SELECT unnest({_FEATURE_NAMES}) AS feature, unnest(range({len(TREE_FEATURES)})) AS k)"
    + "\nSELECT feature, round(coalesce(g / (SELECT sum(g) FROM per), 0), 6) AS score FROM names LEFT JOIN per USING (k)",
)
def q_feature_importance(spark, sf_dir):
    """Gains of a tree of depth two, weighed by rows and summed per feature."""
    model = fitted_on(spark, sf_dir, "decision_tree", TREE_FEATURES, maxDepth=2, minInstancesPerNode=MIN_ROWS)
    return _round(feature_importance(spark, model, top_n=20))


def bundle(spark, sf_dir) -> ModelBundle:
    _, _, cleaning_model = cleaning(spark, sf_dir)
    return ModelBundle(
        model=fitted_model(spark, sf_dir, "decision_tree"),
        model_name="Spark Decision Tree",
        encoding=encoding(spark, sf_dir),
        cleaning=cleaning_model,
    )


def line_bundle(spark, sf_dir) -> ModelBundle:
    """A least-squares line on the area, whose predictions SQL can compute."""
    from pyspark.ml.regression import LinearRegression

    def build():
        train = model_table(spark, sf_dir).where(F.col("split") == "train")
        estimator = LinearRegression(featuresCol="features", labelCol="label", regParam=0.0, solver="normal")
        return fit_model(estimator, [], train, ["log_area"])[0]

    model = _memo(spark, sf_dir, "fit:line", build)
    return ModelBundle(model, "line", ("log_area",), encoding=None, cleaning=cleaning(spark, sf_dir)[2])


@register(
    "score_listings",
    sql.pipeline("model_table")
    + ", fit AS (SELECT regr_slope(label, log_area) AS a, regr_intercept(label, log_area) AS b FROM model_table WHERE split = 'train'), "
    f"r AS (SELECT listing_id, {sql._amount('area_value')} AS area FROM listings)"
    "\nSELECT listing_id, round((SELECT a FROM fit) * ln(1 + area) + (SELECT b FROM fit), 6) AS prediction, "
    "round(exp((SELECT a FROM fit) * ln(1 + area) + (SELECT b FROM fit)) - 1, 3) AS predicted_price_per_sqm FROM r",
)
def q_score_listings(spark, sf_dir):
    """Score every raw listing with the saved cleaning values; null where the area is missing."""
    scored = predict_price_per_sqm(line_bundle(spark, sf_dir), raw(spark, sf_dir), keep=("listing_id",))
    return scored.select(
        "listing_id", F.round("prediction", 6).alias("prediction"), F.round("predicted_price_per_sqm", 3).alias("predicted_price_per_sqm")
    )


@register("model_roundtrip_scores", sql.pipeline("listings") + "\nSELECT listing_id, true AS same FROM listings")
def q_model_roundtrip_scores(spark, sf_dir):
    """Every raw listing, scored in one pass by the bundle and by its reloaded copy."""
    original = bundle(spark, sf_dir)
    reloaded = ModelBundle.load(spark, original.save(scratch_path(spark, "bundle")))
    rows = raw(spark, sf_dir)
    # Scoring parses its columns, so the raw values travel beside them.
    once = predict_price_per_sqm(original, rows.withColumn("given", F.struct(*rows.columns)), keep=("given",))
    once = once.select("given.*", F.col("prediction").alias("before"))
    twice = predict_price_per_sqm(reloaded, once, keep=("listing_id", "before"))
    return twice.select("listing_id", F.col("before").eqNullSafe(F.col("prediction")).alias("same"))


# ---------------------------------------------------------------- hashed splits and samples


def _md5_rule(key: str = "listing_id") -> str:
    return f"substr(md5('42:' || CAST({key} AS VARCHAR)), 1, 8)"


def _share(fraction: str) -> str:
    return f"printf('%08x', CAST(floor({fraction} * 4294967296.0) AS BIGINT))"


@register(
    "random_split",
    sql.pipeline("clean")
    + "\nSELECT listing_id, category, "
    + sql.split_rule().replace("md5(CAST(listing_id AS VARCHAR))", "md5('42:' || CAST(listing_id AS VARCHAR))")
    + " AS split FROM clean",
)
def q_random_split(spark, sf_dir):
    parts = random_split(cleaned(spark, sf_dir).select("listing_id", "category"))
    return union_splits(parts, column="split")


@register(
    "map_sample",
    sql.pipeline("listings")
    + ", points AS (SELECT listing_id, category, TRY_CAST(lat AS DOUBLE) AS lat, TRY_CAST(lon AS DOUBLE) AS lon FROM listings), "
    "good AS (SELECT * FROM points WHERE lat IS NOT NULL AND lon IS NOT NULL), n AS (SELECT count(*) AS n FROM good)"
    f"\nSELECT * FROM good WHERE (SELECT n FROM n) <= 5000 OR {_md5_rule()} < "
    + _share("(5000.0E0 / (SELECT n FROM n))"),
)
def q_map_sample(spark, sf_dir):
    points = raw(spark, sf_dir).select(
        "listing_id", "category", F.col("lat").try_cast("double").alias("lat"), F.col("lon").try_cast("double").alias("lon")
    ).dropna(subset=["lat", "lon"])
    return map_sample(points, 5_000)


@register(
    "segment_sample",
    sql.pipeline("clean")
    + "\nSELECT listing_id, category, area_value, price_egp FROM clean WHERE "
    f"(category = 'buy' AND price_egp < 50000000 AND area_value < 1000 AND {_md5_rule()} < {_share('0.2E0')}) OR "
    f"(category = 'rent' AND price_egp < 100000 AND area_value < 500 AND {_md5_rule()} < {_share('0.5E0')})",
)
def q_segment_sample(spark, sf_dir):
    """A fifth of the buy rows and half of the rent rows, of those inside the chart's caps."""
    price, area = F.col("price_egp"), F.col("area_value")
    caps = {"buy": (price < 50_000_000) & (area < 1_000), "rent": (price < 100_000) & (area < 500)}
    return segment_sample(cleaned(spark, sf_dir).select("listing_id", "category", "area_value", "price_egp"), caps=caps)
