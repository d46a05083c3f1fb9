"""Every registered query against its SQL counterpart on the driver tables."""

import os

import pytest

from jobmart.catalog import ORACLES, QUERIES
from tests.oracle_check import connect, difference

SF_DIR = os.environ.get("JOBMART_TEST_DATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_same_as_sql(spark, con, key):
    assert difference(QUERIES[key](spark, SF_DIR), con, ORACLES[key]) is None


def test_entry_is_stable(spark):
    import __spark_entry__ as contract

    df = contract.entry(spark)
    assert df.dtypes == [("City", "string"), ("jobs", "bigint")]
    assert df.count() > 0
    assert set(QUERIES) <= set(contract.queries())
    assert set(ORACLES) <= set(contract.oracle_sql()) <= set(contract.queries())
