"""The registered queries that SQL can express, against DuckDB."""

from __future__ import annotations

import pytest

from orrery.llm.queries import ORACLES, QUERIES
from tests.compare import connect, oracle_rows, oracle_types, spark_rows, spark_types

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, name):
    db, frame = connect(SF_DIR), QUERIES[name](spark, SF_DIR)
    assert spark_types(frame) == oracle_types(db, ORACLES[name])
    assert spark_rows(frame) == oracle_rows(db, ORACLES[name])
