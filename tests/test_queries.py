"""Every registered query against its SQL in DuckDB."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from orrery.queries import ORACLES, QUERIES
from tests.compare import connect, oracle_rows, oracle_types, spark_rows, spark_types

SF_DIR = contract.SMOKE_DIR


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, db, name):
    frame = contract.queries()[name](spark, SF_DIR)
    assert spark_types(frame) == oracle_types(db, contract.oracle_sql()[name])
    columns, rows = spark_rows(frame)
    wanted_columns, wanted = oracle_rows(db, contract.oracle_sql()[name])
    assert columns == wanted_columns
    assert wanted, "the check must be able to fail"
    assert rows == wanted


def test_entry_has_rows(spark):
    assert contract.entry(spark).columns == [
        "n_name", "avg_supplier_balance", "avg_customer_balance"
    ]
    assert contract.entry(spark).count() > 0


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.items() <= contract.queries().items()
