import os

import pytest

import __spark_entry__ as entry
from commitlake.plans import analysis, extra, logs, problems, scalar
from tests.oracle import DATA, compare, connection

MODULES = (problems, logs, analysis, scalar, extra)
SQL = {n: s for m in MODULES for n, s in m.SQL.items()}
QUERIES = {n: f for m in MODULES for n, f in m.QUERIES.items()}
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    return connection()


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, con, name):
    compare(spark, con, QUERIES[name], SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    QUERIES[name](spark, DATA).collect()


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
