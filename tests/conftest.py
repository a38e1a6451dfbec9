from __future__ import annotations

from uuid import uuid4

import pytest
from pyspark.sql import SparkSession

from orrery.plans.warehouse import Lakehouse, open_lakehouse
from orrery.session import local_session, scratch


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    session = local_session(cores="4", app="tests")
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def place(spark) -> Lakehouse:
    database = f"test_{uuid4().hex}"
    return open_lakehouse(spark, Lakehouse(database, scratch(spark, "test")))


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    before = {}

    def put(**options: str) -> None:
        for name, value in options.items():
            key = name.replace("__", ".")
            before[key] = spark.conf.get(key, None)
            spark.conf.set(key, value)

    yield put
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)
