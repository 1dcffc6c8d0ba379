"""Every registered query against its SQL twin on the smallest tables."""

from __future__ import annotations

import os

import pytest

from concordat import bindings
from tests.oracle import compare, connect

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, TWINS = bindings.load()
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="shared tables are not here")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    if name in TWINS:
        n, issues = compare(df, con, TWINS[name])
        assert not issues, issues
    else:
        assert df.count() > 0
