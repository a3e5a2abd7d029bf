"""Driver contract: entry smoke and every registered query vs its oracle."""

import pytest

import __spark_entry__ as E
from tidewater import catalog
from tidewater.catalog.compare import compare, duckdb_for

QUERIES = catalog.queries()
ORACLES = catalog.oracles()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "weather_day_key" in df.columns


def test_entry_holds_every_library_query():
    assert set(QUERIES) <= set(E.queries())
    assert set(ORACLES) <= set(E.oracle_sql())


def test_every_query_has_an_oracle():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLES) == set()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duckdb_for(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, sf_dir, con, name):
    diff = compare(QUERIES[name](spark, sf_dir), con, ORACLES[name])
    assert diff is None, diff
