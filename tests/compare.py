"""Rows of a Spark query against rows of the same query in DuckDB."""

from __future__ import annotations

import datetime
import decimal

import duckdb
from pyspark.sql import DataFrame

# The tables of the test data.
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return db


# The type names of the two engines for the same thing.
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "date": "DATE", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
}


def spark_types(df: DataFrame) -> dict[str, str]:
    return {name: TYPES.get(kind, kind) for name, kind in df.dtypes}


def oracle_types(db: duckdb.DuckDBPyConnection, sql: str) -> dict[str, str]:
    return {row[0]: row[1] for row in db.execute(f"DESCRIBE {sql}").fetchall()}


def spark_rows(df: DataFrame) -> tuple[list[str], list[tuple]]:
    columns = sorted(df.columns)
    return columns, _sorted([tuple(_plain(r[c]) for c in columns) for r in df.collect()])


def oracle_rows(db: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], list[tuple]]:
    result = db.execute(sql)
    names = [d[0] for d in result.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = [tuple(_plain(r[i]) for i in order) for r in result.fetchall()]
    return sorted(names), _sorted(rows)


def _sorted(rows: list[tuple]) -> list[tuple]:
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


def _plain(value: object) -> object:
    if isinstance(value, decimal.Decimal):
        return int(value) if value == value.to_integral_value() else float(value)
    if isinstance(value, datetime.datetime) and value.time() == datetime.time():
        return value.date()
    return value
