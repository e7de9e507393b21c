"""Every registered query against its SQL counterpart, at the smallest scale."""

from __future__ import annotations

import pytest

import __spark_entry__ as driver
import compare
from fixtures import queries as registry

SF_DIR = "/root/testdata/sf0.001"
QUERIES, SQL = registry.registered(), driver.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(SQL)
    assert set(SQL) <= set(driver.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_matches_sql(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    assert compare.differences(result, duck, SQL[name]) == ""
