"""Every registered query against its DuckDB statement, and the driver's entry points."""

from pathlib import Path

import pytest

import __spark_entry__ as entry_points
from checks.compare import compare, duckdb_connection
from checks.oracles import ORACLES
from checks.queries import QUERIES
from eventlake.session import use_utc

DATA = Path("/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="test tables not there")


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(str(DATA))


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, str(DATA), name) is None


def test_every_query_of_the_engine_has_a_statement():
    assert set(QUERIES) == set(ORACLES)
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_results_do_not_depend_on_the_session_zone(spark, con):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        assert compare(spark, con, str(DATA), "agg_daily_activity") is None
        assert compare(spark, con, str(DATA), "silver_parse") is None
    finally:
        use_utc(spark)


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns[:2] == ["event_date", "repo_id"] and df.count() > 0
