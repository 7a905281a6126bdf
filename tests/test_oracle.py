"""Every registered query against its SQL form, on whole tables."""

import os

import pytest
from oracle import connect, differences

from workload.registry import ORACLES, QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    if name in ORACLES:
        assert differences(df, con, ORACLES[name]) == []
    else:
        assert df.count() > 0


def test_entry(spark):
    import __spark_entry__ as driver

    assert driver.entry(spark).count() > 0
    assert set(driver.oracle_sql()) <= set(driver.queries())
