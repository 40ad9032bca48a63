"""Every registered query against its check SQL on the smallest given tables."""

import os
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from ratesmith.operators import population
from registry import bindings as b, load, rates
from registry.views import Tables
from tools.check import TABLES, normal

DATA = Path(os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001"))
QUERIES, CHECKS = load().QUERIES, load().CHECKS
# operators that multiply rows or leave the JVM row by row
AVOIDED = ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas")

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="given tables not present")


@pytest.fixture(scope="module")
def engine():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{DATA}/{table}.parquet')")
    return connection


def test_every_query_has_a_check():
    assert set(QUERIES) == set(CHECKS)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, engine, name):
    frame = QUERIES[name](spark, str(DATA))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert not [operator for operator in AVOIDED if operator in plan]
    cursor = engine.execute(CHECKS[name])
    columns = [item[0] for item in cursor.description]
    assert sorted(columns) == sorted(frame.columns)
    ours = normal([tuple(row) for row in frame.collect()], frame.columns)
    assert ours == normal(cursor.fetchall(), columns)


def test_flagship_runs(spark):
    assert entry.entry(spark).count() > 0


def test_known_rates(spark):
    """Numbers worked out beforehand, with every practice taken as active."""
    folder = "/root/testdata/sf0.01"
    t = Tables(spark, folder)
    practices = b.practice_mapping(t)
    assert practices.count() == 90
    bands = population.network_bands(
        b.wide_list_size(t), practices, [b.PERIOD.month_start, b.PERIOD.start])
    found = rates.numerator(t, practices, bands).orderBy("PCN_CODE").collect()
    assert len(found) == 24
    assert sum(r.admissions for r in found) == 679
    assert sum(r.standardised_admissions for r in found) == 700
    assert [
        (r.PCN_CODE, r.admissions, r.pcn_pop, round(r.DSR, 8), int(r.standardised_admissions))
        for r in found[:3]
    ] == [("0", 23, 46692, 0.00051062, 24), ("1", 13, 30185, 0.00047828, 14),
          ("10", 51, 91810, 0.00056295, 52)]


def test_unpivot_conserves_the_population(spark):
    t = Tables(spark, str(DATA))
    long = QUERIES["unpivot_wide"](spark, str(DATA)).agg(F.sum("val")).first()[0]
    assert long == t["fx_list_size_snapshots"].agg(F.sum("val")).first()[0]
