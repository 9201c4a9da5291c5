import pytest
from compare import connect, differences

from lodgeflow.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, con, name):
    assert differences(queries.QUERIES[name](spark, SF), con, queries.ORACLES[name]) == []
