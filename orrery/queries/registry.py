"""Registration of queries and loading of their tables."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.plans.warehouse import Lakehouse, open_lakehouse
from orrery.session import scratch

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name, with the SQL that must give the same rows."""

    def register(run: Query) -> Query:
        QUERIES[run.__name__] = run
        if oracle is not None:
            ORACLES[run.__name__] = oracle
        return run

    return register


def exact_avg(column: str) -> str:
    """SQL for an average that does not depend on the order of summation.

    Money has two decimals: summed as decimals it is exact, and one division follows.
    """
    return f"cast(sum(cast({column} AS decimal(18, 2))) AS double) / count({column})"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def orders_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the order date as a date, as the feeds carry it."""
    return load(spark, sf_dir, "orders").withColumn("o_orderdate", F.to_date("o_orderdate"))


def new_lakehouse(spark: SparkSession, purpose: str, comment: str = "") -> Lakehouse:
    """A database of its own for one call, on an unused part of the shared folder."""
    place = Lakehouse(f"{purpose}_{uuid4().hex}", scratch(spark, purpose))
    return open_lakehouse(spark, place, comment)
