import pytest

import __spark_entry__ as driver
from callsieve.llm import queries as llm
from compare import assert_same, duck
from conftest import TESTDATA

SF = TESTDATA / "sf0.001"


@pytest.fixture(scope="module")
def con():
    with duck(SF) as connection:
        yield connection


def test_all_operators_are_registered():
    names = [n.split("_")[0] for n in llm.queries()]
    assert names == [f"op{n}" for n in range(1, 14)]
    assert set(llm.queries()) | {"pipeline"} <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(llm.oracle_sql()))
def test_same_rows_as_sql(spark, con, name):
    assert assert_same((llm.queries() | llm.page_queries())[name](spark, str(SF)), con, llm.oracle_sql()[name]) > 0
