"""Every query against its SQL, and the driver's contract."""

import inspect

import pytest

import __spark_entry__ as contract
from loomset.queries.catalog import QUERIES
from loomset.queries.oracles import ORACLES
from verify_queries import check, duck


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, sf_dir, name):
    outcome = check(spark, con, sf_dir, name)
    assert outcome == "ok", outcome


def test_contract(spark):
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert all(len(inspect.signature(q).parameters) == 2 for q in contract.queries().values())
    assert contract.entry(spark).columns == ["conv_id", "text"]
    assert contract.entry(spark).count() > 0
