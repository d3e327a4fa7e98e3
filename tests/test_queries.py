"""Registered queries against their DuckDB equivalents."""

import pytest
import __spark_entry__ as contract
from churnlens.plans import oracle
from compare import connect, difference

QUERIES, ORACLE = contract.queries(), contract.oracle_sql()
# Those of the llm subpackage have their own tests.
NAMES = sorted(oracle.ORACLE)


@pytest.fixture(scope="module")
def con(data_dir):
    return connect(data_dir)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_oracle(spark, con, data_dir, name):
    assert difference(QUERIES[name](spark, data_dir), con, ORACLE[name]) is None


def test_contract(spark):
    assert set(ORACLE) <= set(QUERIES) and len(QUERIES) > 90
    got = {r["status"]: r["transactions"] for r in contract.entry(spark).collect()}
    assert set(got) == {"Attrited Customer", "Existing Customer"} and sum(got.values()) == 4612
