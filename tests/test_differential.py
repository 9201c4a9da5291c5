"""Every registered query against its SQL counterpart on the given tables."""

import pytest
from compare import connect, differences

import __spark_entry__ as contract

SF_DIR = "/root/testdata/sf0.001"
ORACLE = contract.oracle_sql()
# The optional subpackage brings its own tests for what it registers.
QUERIES = {query.__name__: query for query in contract.QUERIES}


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert QUERIES.keys() <= ORACLE.keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert differences(QUERIES[name](spark, SF_DIR), con, ORACLE[name]) == []


def test_entry_runs(spark):
    assert contract.entry(spark).columns == ["id", "name", "num_reviews"]


def test_comparison_sees_values_types_and_counts(spark, con):
    nation = spark.read.parquet(f"{SF_DIR}/nation.parquet").select("n_nationkey")
    assert differences(nation, con, "SELECT n_nationkey FROM nation") == []
    assert differences(nation, con, "SELECT n_nationkey + 1 AS n_nationkey FROM nation")
    assert differences(nation, con, "SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey FROM nation")
    assert differences(nation, con, "SELECT n_nationkey FROM nation LIMIT 3")
