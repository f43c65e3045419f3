"""Every registered query against its SQL counterpart on the smallest tables."""

import os

import pytest

from medallion.catalog import all_queries
from tests.compare import compare, connect

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, all_queries()[name], SF_DIR) == ""
