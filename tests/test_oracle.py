"""Every registered query against its SQL on the smallest tables."""

import os

import pytest
from compare import connect, difference

from tidemark.catalog import ORACLES, QUERIES

FOLDER = os.environ.get("ORACLE_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no driver tables")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, con, name):
    assert difference(QUERIES[name](spark, FOLDER), con, ORACLES[name]) is None


def test_entry(spark):
    import __spark_entry__ as entry
    assert entry.entry(spark).count() > 0
    assert entry.queries().keys() >= QUERIES.keys()
