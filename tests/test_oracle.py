"""Every registered query against its SQL on the smallest sample."""

from __future__ import annotations

import os

import pytest

from checks.compare import compare, connect
from checks.oracle import ORACLE
from checks.queries import QUERIES

DIRECTORY = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(DIRECTORY), reason="no sample data")


@pytest.fixture(scope="module")
def con():
    return connect(DIRECTORY)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, con, name):
    assert compare(spark, con, DIRECTORY, QUERIES[name], ORACLE[name]) == ""
