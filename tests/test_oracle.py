"""Every key with a SQL oracle matches DuckDB exactly (small scale factor)."""

import pytest

from conftest import SF_SMALL

import __spark_entry__ as E
from oracle_check import compare, duck

KEYS = sorted(E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("key", KEYS)
def test_oracle(spark, con, key):
    ok, msg = compare(spark, con, key, SF_SMALL)
    assert ok, msg
