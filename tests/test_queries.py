"""Every registered query that has SQL, against DuckDB on the smallest tables."""

import compare
import pytest

from notequarry.catalog.all import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, name):
    problems = compare.compare(QUERIES[name](spark, SF_DIR), duck, ORACLES[name])
    assert problems == []
