"""Listings view over the driver's TPC-H-like tables.

The raw listing file of the original job is not available, so every
operator is exercised on rows derived from ``lineitem ⋈ part ⋈ supplier ⋈
nation ⋈ region``.  The derivations are written once as SQL expressions
that parse identically in Spark and DuckDB; Spark evaluates them with
``selectExpr`` (Catalyst, whole-stage codegen), the DuckDB oracle with a
plain SELECT.  The view therefore grows linearly with ``lineitem``.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The view's column derivations (shared with the oracle SQL).
VIEW_COLUMNS: tuple[tuple[str, str], ...] = (
    ("listing_id", "l_orderkey * 10 + l_linenumber"),
    ("category", "CASE WHEN l_returnflag = 'R' THEN 'rent' ELSE 'buy' END"),
    ("property_type", "p_type"),
    ("city", "r_name"),
    ("town", "CASE WHEN l_suppkey % 23 = 0 THEN NULL ELSE n_name END"),
    ("district", "p_brand"),
    (
        "price_egp",
        "CASE WHEN l_orderkey % 97 = 0 THEN NULL "
        "WHEN l_orderkey % 89 = 0 THEN 'Ask for price' "
        "WHEN l_returnflag = 'R' THEN 'EGP ' || CAST(CAST(FLOOR(l_extendedprice) AS BIGINT) AS STRING) "
        "ELSE 'EGP ' || CAST(CAST(FLOOR(l_extendedprice * 100) AS BIGINT) AS STRING) END",
    ),
    ("area_value", "CAST(CAST(5 + l_quantity * 31 AS BIGINT) AS STRING) || ' sqm'"),
    (
        "bedrooms",
        "CASE p_size % 10 WHEN 0 THEN NULL WHEN 9 THEN '7+' WHEN 8 THEN ' Studio ' "
        "WHEN 7 THEN 'n/a' ELSE CAST(p_size % 10 AS STRING) END",
    ),
    (
        "bathrooms",
        "CASE WHEN l_linenumber = 7 THEN '7+' WHEN l_partkey % 31 = 0 THEN 'none' "
        "ELSE CAST(l_linenumber AS STRING) END",
    ),
    ("lat", "CASE WHEN l_suppkey % 41 = 0 THEN NULL ELSE 22.0E0 + (l_suppkey % 90) / 10.0E0 END"),
    ("lon", "25.0E0 + (l_partkey % 100) / 10.0E0"),
    ("furnished", "CASE l_partkey % 4 WHEN 0 THEN 'YES' WHEN 1 THEN ' yes ' WHEN 2 THEN 'NO' ELSE NULL END"),
    (
        "completion_status",
        "CASE l_orderkey % 5 WHEN 0 THEN 'completed' WHEN 1 THEN 'off_plan' "
        "WHEN 2 THEN 'Completed_Primary' WHEN 3 THEN 'off_plan_primary' ELSE NULL END",
    ),
    (
        "payment_method",
        "CASE l_orderkey % 7 WHEN 0 THEN 'cash' WHEN 1 THEN 'Installments' "
        "WHEN 2 THEN 'cash | installments' WHEN 3 THEN 'installments | cash' "
        "WHEN 4 THEN 'mortgage' WHEN 5 THEN 'Cash, install plan' ELSE NULL END",
    ),
    (
        "amenities",
        "CASE l_partkey % 6 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'Private Pool|Security' "
        "WHEN 3 THEN 'Balcony|A/C|Shared Gym|' WHEN 4 THEN 'Covered Parking|Private Garden|Spa|Pool' "
        "ELSE 'Storage Space' END",
    ),
    ("listed_date", "CASE WHEN l_orderkey % 53 = 0 THEN NULL ELSE l_shipdate END"),
    ("is_premium", "CASE l_orderkey % 3 WHEN 0 THEN 'True' WHEN 1 THEN 'no' ELSE NULL END"),
    ("is_verified", "CASE WHEN l_partkey % 2 = 0 THEN '1' ELSE 'maybe' END"),
    ("is_new_construction", "CAST(l_linenumber % 2 AS STRING)"),
    ("is_direct_from_dev", "l_linestatus = 'O'"),
    ("images_count", "CASE WHEN l_suppkey % 9 = 0 THEN NULL ELSE CAST(l_suppkey % 30 AS STRING) END"),
    ("contact_phone", "'+20-' || CAST(l_suppkey AS STRING)"),
    ("agent_email", "CAST(l_partkey AS STRING) || '@x.example'"),
    ("tie_partkey", "l_partkey"),
    ("tie_suppkey", "l_suppkey"),
    ("tie_price", "l_extendedprice"),
    ("tie_ship", "l_shipdate"),
)

# Columns that give a total order within one listing_id (dedup tie-break).
TIE_COLUMNS = ("tie_partkey", "tie_suppkey", "tie_price", "tie_ship")

LINEITEM_COLUMNS = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
    "l_extendedprice", "l_returnflag", "l_linestatus", "l_shipdate",
)

# What all view columns are derived from, and the same total order in it: a
# shuffle of these moves less than half of what one of the derived text does.
SOURCE_COLUMNS = (*LINEITEM_COLUMNS, "p_type", "p_brand", "p_size", "n_name", "r_name")
SOURCE_TIES = ("l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Round-robin the rows over the cluster when the scan has fewer input
    partitions than cores (e.g. one file with a single row group, which one
    task would otherwise process alone).  Inputs already split into at
    least ``defaultParallelism`` partitions are left as they are, so this
    adds no shuffle at scale."""
    try:
        cores = df.sparkSession.sparkContext.defaultParallelism
        splits = df.rdd.getNumPartitions()
    except Exception:  # no RDD view of the plan (e.g. a Spark Connect session)
        return df
    return df.repartition(cores) if splits < cores else df


def _tokens(names: tuple[str, ...]) -> set[str]:
    """The table columns that the view columns' expressions name."""
    return {token for name, expression in VIEW_COLUMNS if name in names for token in re.findall(r"[a-z]+_[a-z]+", expression)}


def _joined(spark: SparkSession, sf_dir: str, read: set[str]) -> DataFrame:
    """``lineitem`` with the dimensions that the columns ``read`` come from."""

    def table(name: str, *names: str) -> DataFrame:
        return read_table(spark, sf_dir, name).select(*names)

    by_part, by_region = {"p_type", "p_brand", "p_size"} & read, "r_name" in read
    by_nation = by_region or "n_name" in read
    keys = {"l_partkey"} & (read if not by_part else {"l_partkey"}) | {"l_suppkey"} & (read if not by_nation else {"l_suppkey"})
    lines = [name for name in LINEITEM_COLUMNS if name in read | keys]
    joined = spread(table("lineitem", *lines))
    if by_part:
        joined = joined.join(table("part", "p_partkey", *sorted(by_part)), F.col("l_partkey") == F.col("p_partkey"))
    if by_nation:
        nations = table("nation", "n_nationkey", "n_name", "n_regionkey")
        if by_region:
            nations = nations.join(table("region", "r_regionkey", "r_name"), F.col("n_regionkey") == F.col("r_regionkey"))
        joined = joined.join(table("supplier", "s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
        joined = joined.join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
    return joined


def derived_listings(rows: DataFrame, columns: tuple[str, ...] = ()) -> DataFrame:
    """The view's columns (some of them with ``columns``) of rows that hold what they are derived from."""
    wanted = columns or tuple(name for name, _ in VIEW_COLUMNS)
    return rows.selectExpr(*[f"{expression} AS {name}" for name, expression in VIEW_COLUMNS if name in wanted])


def listing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``listing_id`` and ``SOURCE_COLUMNS`` of every raw listing, before anything else is derived.

    ``derived_listings`` makes the view's rows of them.  Whoever drops rows by
    ``listing_id`` first, in the order of ``SOURCE_TIES``, gets the same
    listings and shuffles and sorts fewer bytes.
    """
    key = dict(VIEW_COLUMNS)["listing_id"]
    return _joined(spark, sf_dir, set(SOURCE_COLUMNS)).selectExpr(f"{key} AS listing_id", *SOURCE_COLUMNS)


def listings_view(spark: SparkSession, sf_dir: str, columns: tuple[str, ...] = ()) -> DataFrame:
    """Raw listings (strings as scraped) derived from the star schema; ``columns`` keeps some of them only.

    A dimension that none of the columns reads is not joined: every line has
    its part and supplier, every supplier its nation, every nation its region
    (foreign keys), so such a join would change no row.  ``nation`` and
    ``region`` have a fixed size (25 and 5 rows), ``part`` and ``supplier`` grow
    with the scale factor; all are left to the planner, which knows the files'
    sizes, and to AQE.
    """
    wanted = columns or tuple(name for name, _ in VIEW_COLUMNS)
    return derived_listings(_joined(spark, sf_dir, _tokens(wanted)), wanted)


def listings_sql() -> str:
    """The same view as DuckDB SQL (used by the oracle queries)."""
    projection = ",\n  ".join(f"{expression} AS {name}" for name, expression in VIEW_COLUMNS)
    return (
        f"SELECT\n  {projection}\n"
        "FROM lineitem\n"
        "JOIN part ON l_partkey = p_partkey\n"
        "JOIN supplier ON l_suppkey = s_suppkey\n"
        "JOIN nation ON s_nationkey = n_nationkey\n"
        "JOIN region ON n_regionkey = r_regionkey"
    )
