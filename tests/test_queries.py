"""Every registered query against its SQL on the smallest tables."""

import check_queries
import pytest

import __spark_entry__ as entry
from lotwise.plans.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return check_queries.oracle(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert check_queries.compare(spark, con, SF, name) is None


def test_contract(spark):
    assert set(SQL) == set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
