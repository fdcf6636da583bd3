"""Shapes of physical plans that the design relies on."""

from __future__ import annotations

import re

import pytest

from aqarlens.catalog import queries as q
from aqarlens.operators import profiling
from aqarlens.sources.listings_view import listings_view
from aqarlens.session import _FOLDERS, drop_folders, own_folder


def _final(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", ["feature_summary", "feature_correlations", "correlation_matrix", "missing_values"])
def test_wide_aggregates_stay_in_generated_code(spark, sf_dir, name):
    plan = _final(q.QUERIES[name](spark, sf_dir))
    aggregates = re.findall(r"^.*HashAggregate.*$", plan, flags=re.M)
    assert aggregates and all(re.search(r"\*\(\d+\) HashAggregate", line) for line in aggregates)


def _read(plan):
    return [{c.split(":")[0] for c in schema.split(",") if c} for schema in re.findall(r"ReadSchema: struct<(.*?)>", plan)]


def _planned(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["feature_summary", "feature_correlations", "correlation_matrix"])
def test_profiles_take_one_scan(spark, tmp_path, name):
    path = str(tmp_path / "t")
    spark.range(50).selectExpr(*[f"cast(id * {k + 1} % 17 as double) AS c{k}" for k in range(40)]).write.parquet(path)
    names = [f"c{k}" for k in range(39)]
    frame = spark.read.parquet(path)
    made = {
        "feature_summary": lambda: profiling.feature_summary(frame, names),
        "feature_correlations": lambda: profiling.feature_correlations(frame, names, "c39"),
        "correlation_matrix": lambda: profiling.correlation_matrix(frame, names[:12]),
    }[name]()
    assert len(re.findall(r"FileScan parquet", _final(made))) == 1


def test_constant_columns_have_no_correlation(spark):
    frame = spark.range(5).selectExpr("cast(id as double) as a", "1.0D as b", "2.0D * id as c", "if(id = 1, null, 3.0D * id) as d")
    got = {r.feature: r.pearson_r for r in profiling.feature_correlations(frame, ["a", "b", "d"], "c").collect()}
    assert got == {"a": pytest.approx(1.0), "b": None, "d": pytest.approx(1.0)}


@pytest.mark.parametrize(
    ("name", "columns"),
    [("category_shares", [{"l_returnflag"}]), ("top_property_types", [{"l_partkey"}, {"p_partkey", "p_type"}])],
)
def test_queries_join_and_read_what_they_need(spark, sf_dir, name, columns):
    plan = _planned(q.QUERIES[name](spark, sf_dir))
    assert _read(plan)[: len(columns)] == columns and all(c in columns for c in _read(plan))
    assert "aqarlens-stages" not in plan


def test_shares_keep_groups_apart(spark, sf_dir):
    """Only partial sums, a row per task, meet in one task."""
    plan = _planned(q.QUERIES["category_shares"](spark, sf_dir))
    assert "Window" not in plan
    for line in re.findall(r"Exchange SinglePartition.*\n(.*)", plan):
        assert "HashAggregate" in line and "partial_sum" in line


def test_one_encoding_reads_its_columns(spark, sf_dir):
    plan = _planned(q.QUERIES["city_price_summary"](spark, sf_dir))
    rows = [columns for columns in _read(plan) if "listing_id" in columns or "price_per_sqm" in columns]
    assert all(columns <= {"category", "city", "price_per_sqm"} for columns in rows)


def test_view_columns_alone_are_those_of_the_whole_view(spark, sf_dir):
    whole = listings_view(spark, sf_dir)
    for columns in (("listing_id", "town"), ("city", "bedrooms"), ("images_count", "lat"), ("district",)):
        part, same = listings_view(spark, sf_dir, columns), whole.select(*columns)
        assert set(part.columns) == set(columns)
        assert part.select(*columns).exceptAll(same).count() == 0 and same.exceptAll(part.select(*columns)).count() == 0


def test_folders_are_removed(spark, tmp_path):
    path = own_folder(spark, "scratch")
    spark.range(3).write.parquet(path)
    _, folders = _FOLDERS[spark.sparkContext.applicationId]
    held = [f for f in folders if f != path]
    folders[:] = [path]
    drop_folders(spark)
    folders[:] = held
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        spark.read.parquet(path).count()


@pytest.mark.parametrize("name", ["model_roundtrip_scores", "score_listings"])
def test_scoring_is_code_that_the_jvm_compiles(spark, sf_dir, name):
    """No method of generated code passes 8,000 bytes, from which on the JVM interprets it."""
    with_aqe = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        execution = q.QUERIES[name](spark, sf_dir)._jdf.queryExecution()
        code = execution.explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", with_aqe)
    sizes = [int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", code)]
    assert sizes and max(sizes) < 8_000


def test_scored_rows_can_be_read_twice(spark, sf_dir):
    scored = q.QUERIES["score_listings"](spark, sf_dir)
    both = scored.alias("a").join(scored.alias("b"), "listing_id").union(scored.select("*", "prediction", "predicted_price_per_sqm"))
    n, ids = scored.count(), scored.select("listing_id").distinct().count()
    assert both.select("listing_id").distinct().count() == ids and both.count() >= 2 * n
