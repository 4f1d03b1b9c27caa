"""Every query of the subpackage against its SQL on the smallest tables."""

import os

import pytest

from compare import SMALL, same, views
from trajecta.llm import queries

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")
QUERIES, SQL = queries.queries(), queries.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return views(SMALL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, con, name):
    same(spark, con, QUERIES[name], SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0
