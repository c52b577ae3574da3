"""Every registered query against its SQL, on the smallest tables."""

import os

import pytest

from feedweir.plans.registry import all_queries
from tests.compare import difference, oracle

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = all_queries()


@pytest.fixture(scope="module")
def con():
    return oracle(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    q = QUERIES[name]
    df = q.plan(spark, SF)
    if q.sql is None:
        df.count()
    else:
        assert difference(df, con, q.sql) is None
