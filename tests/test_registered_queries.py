"""Every registered query against its SQL, at the smallest scale."""

import pytest
from compare import compare, connect

import __spark_entry__ as contract
from metermill.workload.catalog import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_contract(spark):
    assert QUERIES.keys() == ORACLE.keys() <= contract.oracle_sql().keys() <= contract.queries().keys()
    assert contract.entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    assert compare(spark, duck, SF, QUERIES[name], ORACLE[name]) == ""
