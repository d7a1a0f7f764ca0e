"""Every registered query against DuckDB, and the driver contract."""

import os

import pytest

import __spark_entry__ as driver
from tallybook.plans.catalog import CATALOG
from tests.oracle import compare, connect

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(CATALOG))
def test_query_agrees_with_sql(spark, con, name):
    assert compare(spark, con, driver.queries()[name], driver.oracle_sql()[name], SF) is None


def test_entry(spark):
    out = driver.entry(spark)
    assert out.columns == ["profile_id", "year", "month", "category", "subcategory", "total_amount"]
    assert out.count() > 0


def test_every_query_has_sql():
    assert all(sql for _, sql in CATALOG.values())
    assert set(CATALOG) <= set(driver.queries()) and set(driver.oracle_sql()) <= set(driver.queries())
