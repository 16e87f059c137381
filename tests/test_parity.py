"""Every registered query against its oracle on the smallest data."""

import pytest
from conftest import SF_DIR

import __spark_entry__ as contract
from clickweir.parity.compare import differences, oracle_connection
from clickweir.parity.oracle import ORACLE_SQL
from clickweir.parity.queries import QUERIES


@pytest.fixture(scope="module")
def oracle():
    return oracle_connection(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, oracle, name):
    assert differences(spark, oracle, name, SF_DIR) == []


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLE_SQL.keys()
    assert contract.queries().keys() >= QUERIES.keys()


def test_entry_is_the_flagship_query(spark):
    result = contract.entry(spark)
    assert result.columns == ["day", "platformDimension", "browserDimension", "total"]
    assert result.count() > 0
