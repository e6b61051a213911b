import pytest

import __spark_entry__ as driver
import sql_checks
from compare import assert_same, duck
from conftest import TESTDATA

SF = TESTDATA / "sf0.001"


@pytest.fixture(scope="module")
def con():
    with duck(SF) as connection:
        yield connection


def test_every_query_of_the_library_is_checked():
    assert set(driver._own_queries()) == set(sql_checks.checks())
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(sql_checks.checks()))
def test_same_rows_as_sql(spark, con, name):
    assert assert_same(driver.queries()[name](spark, str(SF)), con, driver.oracle_sql()[name]) > 0


def test_entry(spark):
    assert driver.entry(spark).count() == 249
