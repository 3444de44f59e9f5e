"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import compare, connect
from tests.conftest import SMALL

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")
QUERIES, SQL = queries(), oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    if name in SQL:
        assert compare(spark, con, QUERIES[name], SQL[name], SMALL) is None
    else:
        assert QUERIES[name](spark, SMALL).count() > 0


def test_names_agree():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    first, second = entry(spark), entry(spark)
    assert first.schema == second.schema
    assert first.count() > 0
