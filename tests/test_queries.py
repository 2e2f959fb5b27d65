"""Every registered query against its DuckDB equivalent."""

import pytest

import __spark_entry__ as driver
from tests.oracle import connect, difference

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_an_equivalent():
    assert set(driver.table_queries()) == set(driver.table_oracle_sql())


@pytest.mark.parametrize("name", sorted(driver.table_queries()))
def test_query(spark, duck, name):
    assert difference(driver.table_queries()[name](spark, SF_DIR), duck, driver.table_oracle_sql()[name]) is None


def test_entry(spark):
    result = driver.entry(spark)
    assert result.columns == ["x", "y", "prediction"]
    assert {row.prediction for row in result.select("prediction").distinct().collect()} == {0, 1, 2}
