import pytest

import __spark_entry__ as registered
from registry.oracles import ORACLES
from registry.queries import QUERIES
from compare import connect, spark_rows, sql_rows

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_its_sql(spark, connection, name):
    assert spark_rows(QUERIES[name](spark, SF)) == sql_rows(connection, ORACLES[name])


def test_entry(spark):
    assert registered.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(registered.queries()) and set(ORACLES) <= set(registered.oracle_sql())
