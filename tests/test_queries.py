import pytest
from compare import differences, duck

import __spark_entry__ as contract


@pytest.fixture(scope="module")
def connection():
    return duck("/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_sql(spark, sf_dir, connection, name):
    result = contract.queries()[name](spark, sf_dir)
    assert differences(result, connection, contract.oracle_sql()[name]) == []


def test_every_check_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_gives_rows(spark):
    assert contract.entry(spark).limit(1).count() == 1
