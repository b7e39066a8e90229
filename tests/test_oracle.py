"""Every registered query equals its DuckDB oracle (the driver's correctness gate)."""

import pytest

import __spark_entry__ as entry
from pagesift.plans import catalog
from conftest import SF001, SF01
from oracle import compare, duck

QUERIES = catalog.queries()         # those of the training-data subpackage have tests of their own
ORACLE = catalog.oracle_sql()


@pytest.fixture(scope="module")
def con001():
    return duck(SF001)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle_sf0001(spark, con001, name):
    n, problems = compare(QUERIES[name](spark, SF001), con001, ORACLE[name])
    assert not problems, problems


@pytest.mark.parametrize("name", ["postcode_pages", "segment_status", "run_report"])
def test_query_matches_oracle_sf001(spark, name):
    n, problems = compare(QUERIES[name](spark, SF01), duck(SF01), ORACLE[name])
    assert not problems, problems


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["crawl_date", "segment", "record_no", "uri", "website", "postcodes", "text"]
    assert df.count() == 40
