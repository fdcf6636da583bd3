"""Every registered query at sf0.001: oracle queries against DuckDB, the
rest for rows and their properties."""

from __future__ import annotations

import math
from collections import Counter
from datetime import date, datetime

import duckdb
import pytest

import __spark_entry__ as entry
from aqarlens.catalog.queries import ORACLES, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _norm(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, (datetime, date)):
        return value.isoformat()
    return value


def _multiset(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for table in TABLES:
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def test_entry_runs(spark):
    out = entry.entry(spark)
    assert out.count() > 0
    assert "avg_price_per_sqm" in out.columns


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    rel = duck.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert _multiset(df.columns, [tuple(r) for r in df.collect()]) == _multiset(rel.columns, rel.fetchall())


def test_correlations_are_sorted(spark, sf_dir):
    values = [r["pearson_r"] for r in QUERIES["feature_correlations"](spark, sf_dir).collect()]
    known = [v for v in values if v is not None]
    assert known == sorted(known) and len(values) == 33


def test_top_types_are_sorted(spark, sf_dir):
    rows = [(-r["count"], r["property_type"]) for r in QUERIES["top_property_types"](spark, sf_dir).collect()]
    assert rows == sorted(rows)
