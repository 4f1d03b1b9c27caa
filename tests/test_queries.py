"""Every query of the core against its SQL on the smallest tables."""

import os

import pytest

from compare import SMALL, same, views
from trajecta.plans import found, registry

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")
QUERIES = registry.queries() | found.queries()
SQL = registry.oracle_sql() | found.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return views(SMALL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, con, name):
    same(spark, con, QUERIES[name], SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SMALL).collect()


def test_noise_stays_within(spark):
    got = {r["outcome"] for r in QUERIES["augment_noise"](spark, SMALL).collect()}
    assert got <= {"within", "dropped"} and "within" in got
