"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import pytest

from __spark_entry__ import entry
from check import connect, differences
from tests.conftest import SMALL
from tidewater.catalog import QUERIES, SQL


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_agrees_with_sql(spark, con, name):
    assert differences(spark, con, SMALL, name) is None


#: What SQL cannot say is held against plain loops elsewhere: the cheapest path of a lattice in test_segment.
NO_SQL = {"segment_documents"}


def test_every_query_has_sql():
    assert set(QUERIES) - NO_SQL == set(SQL)


def test_entry(spark):
    df = entry(spark)
    assert df.columns[0] == "id" and df.limit(1).count() == 1
