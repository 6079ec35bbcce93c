"""Every named query against its SQL on the smallest data set."""

import pytest

import __spark_entry__ as driver
from tests.compare import difference
from tests.conftest import SF_SMALL

ORACLES = driver.oracle_sql()


@pytest.mark.parametrize("name", list(driver.catalog.QUERIES))
def test_query(spark, name):
    assert name in ORACLES
    assert difference(spark, SF_SMALL, name, driver.queries()[name], ORACLES[name]) is None


def test_entry(spark):
    assert "SOCIAL_LIFE" in driver.entry(spark).columns
