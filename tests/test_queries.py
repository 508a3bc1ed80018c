"""Every registered query on the smallest tables, against its SQL in DuckDB."""

import os
from pathlib import Path

import pytest

from compare import connect, difference
from salesloom.catalog.queries import ORACLE, QUERIES

FOLDER = os.environ.get("TESTDATA_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    assert difference(QUERIES[name](spark, FOLDER), con, ORACLE[name]) is None
