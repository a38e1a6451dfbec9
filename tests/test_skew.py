"""Audits, cascades and quarantine against brute force where one key holds a third of all rows.

Broadcasts are off and the thresholds of the adaptive skew join low, as if the rows were many.
"""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from orrery.models.table import Reference
from orrery.operators.audits import fk_orphans
from orrery.operators.cascade import cascade_delete, cascade_update
from orrery.operators.joins import Dim, unmatched

N = 120_000
ROWS = [(i, 7 if i % 3 == 0 else None if i % 50 == 1 else i % 1000) for i in range(N)]
REFERENCES = (Reference("child", ("k",), "parent", ("k",)),)


@pytest.fixture(autouse=True)
def many_rows(conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="1b",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="32k",
        spark__sql__adaptive__coalescePartitions__enabled="false",
    )


@pytest.fixture
def tables(spark):
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, F.lit(None))
    child = spark.range(N).select("id", key.otherwise(F.col("id") % 1000).alias("k"))
    parent = spark.range(900).select(F.col("id").alias("k"), (F.col("id") % 10).alias("g"))
    return {"child": child.repartition(8), "parent": parent}


def rows_of(df):
    """The rows, after making sure that the hot key's partition was split."""
    rows = df.collect()
    assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
    return rows


def test_orphans(tables):
    orphans = fk_orphans(tables["child"], ["k"], tables["parent"], ["k"]).collect()
    assert {r.k: r.n_rows for r in orphans} == Counter(
        k for _, k in ROWS if k is not None and k >= 900
    )


def test_deleting_the_hot_key(tables):
    left, _ = cascade_delete(tables, REFERENCES, "parent", "g = 7")
    assert sorted(r.id for r in rows_of(left["child"])) == [
        i for i, k in ROWS if k is None or k >= 900 or k % 10 != 7
    ]


def test_changing_the_hot_key(tables):
    moves = tables["parent"].select(F.col("k").alias("old"), (F.col("k") + 10_000).alias("new"))
    changed, _ = cascade_update(tables, REFERENCES, "parent", "k", moves)
    assert {r.id: r.k for r in rows_of(changed["child"])} == {
        i: k if k is None or k >= 900 else k + 10_000 for i, k in ROWS
    }


def test_rows_without_a_dimension(tables):
    lost = unmatched(tables["child"], [Dim(tables["parent"], {"k": "k"}, {"g": "g"})])
    assert sorted(r.id for r in rows_of(lost)) == [
        i for i, k in ROWS if k is None or k >= 900
    ]
