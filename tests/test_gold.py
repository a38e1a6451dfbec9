from __future__ import annotations

from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orrery.operators.gold import gold_avg_by_group

MEASURES = {"f_avg": ("fact", "x"), "b_avg": ("bridge", "y"), "d_avg": ("dim", "z")}
KEYS = st.one_of(st.none(), st.integers(0, 3))
VALUES = st.one_of(st.none(), st.integers(-1000, 1000).map(lambda n: Decimal(n) / 100))


def plain(fact, bridge, dim):
    f, b, d = fact.alias("f"), bridge.alias("b"), dim.alias("d")
    joined = f.join(b, F.col("f.k") == F.col("b.k")).join(d, F.col("b.k") == F.col("d.k"))
    return joined.groupBy("d.title").agg(
        F.avg("f.x").cast("double").alias("f_avg"),
        F.avg("b.y").cast("double").alias("b_avg"),
        F.avg("d.z").cast("double").alias("d_avg"),
    )


def frames(spark, fact, bridge, dim):
    return (
        spark.createDataFrame(fact, "k int, x decimal(8,2)"),
        spark.createDataFrame(bridge, "k int, y decimal(8,2)"),
        spark.createDataFrame(dim, "k int, title string, z decimal(8,2)"),
    )


def assert_equal(got, want):
    got = {r.title: r for r in got.collect()}
    want = {r.title: r for r in want.collect()}
    assert got.keys() == want.keys()
    for title, row in want.items():
        for name in MEASURES:
            expected = None if row[name] is None else pytest.approx(row[name], abs=1e-5)
            assert got[title][name] == expected


@settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    fact=st.lists(st.tuples(KEYS, VALUES), max_size=8),
    bridge=st.lists(st.tuples(KEYS, VALUES), max_size=8),
    dim=st.lists(st.tuples(KEYS, st.sampled_from(["a", "b"]), VALUES), max_size=5),
)
def test_equals_the_plain_join(spark, fact, bridge, dim):
    f, b, d = frames(spark, fact, bridge, dim)
    got = gold_avg_by_group(f, b, d, ("k", "k", "k"), "title", MEASURES)
    assert_equal(got, plain(f, b, d))


def test_keys_sharing_a_title_weigh_by_their_fan_out(spark):
    f, b, d = frames(
        spark,
        [(1, None)] * 3 + [(2, None)],
        [(1, None)] * 2 + [(2, None)],
        [(1, "t", Decimal(10)), (2, "t", Decimal(20))],
    )
    row = gold_avg_by_group(f, b, d, ("k", "k", "k"), "title", MEASURES).first()
    assert row.d_avg == pytest.approx((6 * 10 + 1 * 20) / 7)
    assert row.f_avg is None


def test_a_hot_key_is_combined_before_any_exchange(spark):
    """The 40 billion joined rows of this key are never built."""
    n = 200_000
    fact = spark.range(n).select(F.lit(1).alias("k"), F.lit(2.0).alias("x"))
    bridge = spark.range(n).select(F.lit(1).alias("k"), F.col("id").cast("double").alias("y"))
    dim = spark.createDataFrame([(1, "t", 5.0)], "k int, title string, z double")
    averages = gold_avg_by_group(fact, bridge, dim, ("k", "k", "k"), "title", MEASURES)
    row = averages.first()
    assert (row.f_avg, row.b_avg, row.d_avg) == (2.0, (n - 1) / 2, 5.0)
