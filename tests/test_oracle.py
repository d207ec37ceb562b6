"""Every query against its SQL on the test data (the smallest set, to keep the suite quick)."""

import os

import pytest

from cohortframe.catalog import ORACLES, QUERIES
from tests.oracle import compare, database

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return database(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, name, FOLDER) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_gives_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_entry_contract(spark):
    import __spark_entry__ as contract

    assert set(contract.oracle_sql()) <= set(contract.queries())
    row = contract.entry(spark).first()
    assert len(row.x) == len(row.mask) == 10 and len(row.x[0]) == len(row.mask[0])
