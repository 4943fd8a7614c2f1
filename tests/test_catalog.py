import pytest

import __spark_entry__ as contract
from tests.oracle_check import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    rows, wanted, _, difference = compare(spark, con, SF, name)
    assert difference is None and rows == wanted


def test_every_query_is_callable():
    assert set(contract.oracle_sql()) <= set(contract.queries())
