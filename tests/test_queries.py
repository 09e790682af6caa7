import pytest

from compare import connect, spark_table, sql_table
from entityframe.plans.oracles import ORACLES
from entityframe.plans.queries import QUERIES


@pytest.fixture(scope="module")
def con(data):
    return connect(data)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_sql(spark, data, con, name):
    expected_names, expected = sql_table(con, ORACLES[name])
    names, rows = spark_table(QUERIES[name](spark, data))
    assert names == expected_names
    assert len(rows) == len(expected)
    assert rows == expected
