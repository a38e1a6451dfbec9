from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from orrery.operators.joins import Dim, star_join, unmatched

FACT = [(1, 10), (2, 20), (3, None), (4, 99), (5, 30)]


@pytest.fixture(scope="module")
def frames(spark):
    fact = spark.createDataFrame(FACT, "id int, shop int")
    shops = spark.createDataFrame([(10, 1), (20, 2), (30, None)], "shop int, town int")
    towns = spark.createDataFrame([(1, "x"), (3, "z")], "town int, name string")
    return fact, shops, towns


def dims(shops, towns, salts=1):
    return [
        Dim(shops, {"shop": "shop"}, {"town_key": "town"}, salts, ("id",)),
        Dim(towns, {"town_key": "town"}, {"town_name": "name"}, salts),
    ]


def test_null_and_unknown_keys_drop_the_row(frames):
    fact, shops, towns = frames
    rows = star_join(fact, dims(shops, towns)).collect()
    assert [(r.id, r.shop, r.town_key, r.town_name) for r in rows] == [(1, 10, 1, "x")]


def test_unmatched_lists_the_rest_with_the_dimensions_lacking(frames):
    fact, shops, towns = frames
    rows = unmatched(fact, dims(shops, towns)).orderBy("id").collect()
    assert [(r.id, r.missing) for r in rows] == [
        (2, [1]), (3, [0, 1]), (4, [0, 1]), (5, [1])
    ]


def test_duplicate_dimension_keys_multiply_rows(spark, frames):
    fact, shops, _ = frames
    twice = shops.unionByName(shops.filter("shop = 10"))
    rows = star_join(fact, [Dim(twice, {"shop": "shop"}, {"town_key": "town"})]).collect()
    assert sorted(r.id for r in rows) == [1, 1, 2, 5]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salts_change_no_row(frames, how):
    fact, shops, towns = frames
    plain = star_join(fact, dims(shops, towns), how)
    salted = star_join(fact, dims(shops, towns, salts=7), how)
    assert salted.columns == plain.columns
    assert sorted(salted.collect(), key=str) == sorted(plain.collect(), key=str)


def hot_fact(spark):
    """A third of the rows hold one key."""
    return spark.range(60_000).select(
        "id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("shop")
    )


def test_salts_spread_a_hot_key_over_partitions(spark, conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__enabled="false",
    )
    shops = spark.range(60_000).select(F.col("id").alias("shop"))

    def largest_share(salts):
        joined = star_join(hot_fact(spark), [Dim(shops, {"shop": "shop"}, {}, salts, ("id",))])
        sizes = joined.groupBy(F.spark_partition_id().alias("p")).count()
        row = sizes.agg(F.max("count").alias("largest"), F.sum("count").alias("all")).first()
        assert row["all"] == 60_000
        return row.largest / row["all"]

    assert largest_share(1) > 1 / 3
    assert largest_share(64) < 1 / 4


def test_a_large_dimension_is_shuffled_and_its_hot_key_split(spark, conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="1b",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="16k",
        spark__sql__adaptive__coalescePartitions__enabled="false",
    )
    shops = spark.range(60_000).select(F.col("id").alias("shop"))
    joined = star_join(hot_fact(spark).repartition(6), [Dim(shops, {"shop": "shop"})])
    assert len(joined.collect()) == 60_000
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin(skew=true)" in plan


def test_copies_of_a_salted_dimension_are_not_broadcast(frames):
    fact, shops, _ = frames
    joined = star_join(fact, [Dim(shops, {"shop": "shop"}, {"town_key": "town"}, 16, ("id",))])
    assert sorted(r.id for r in joined.collect()) == [1, 2, 5]
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
