from __future__ import annotations

import pytest

from pyspark.sql import functions as F

from orrery.operators import keys
from orrery.operators.keys import assign_keys, number_rows
from orrery.session import release_scratch, write_scratch


def numbers(df, key="k"):
    return sorted(r[key] for r in df.collect())


def test_keys_are_dense_and_ordered_over_many_partitions(spark, conf):
    conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    rows = spark.range(1000).select((F.col("id") * 37 % 1000).alias("n")).repartition(7)
    keyed = assign_keys(rows, ["n"], "k")
    assert [(r.n, r.k) for r in keyed.orderBy("n").collect()] == [(n, n + 1) for n in range(1000)]


def test_repeats_share_a_key_and_missing_keys_get_none(spark):
    rows = spark.createDataFrame(
        [("b", 1), ("a", 1), ("b", 1), (None, 1), ("a", None), ("a", 2)], "x string, y int"
    )
    keyed = assign_keys(rows, ["x", "y"], "k")
    assert sorted((r.x, r.y, r.k) for r in keyed.collect()) == [
        ("a", 1, 1), ("a", 2, 2), ("b", 1, 3)
    ]


def test_known_keys_stay_and_new_ones_continue(spark):
    first = assign_keys(spark.range(5, 10).toDF("n"), ["n"], "k", start=100)
    second = assign_keys(spark.range(0, 12).toDF("n"), ["n"], "k", existing=first)
    got = {r.n: r.k for r in second.collect()}
    assert {n: got[n] for n in range(5, 10)} == {n: 95 + n for n in range(5, 10)}
    assert sorted(got[n] for n in (0, 1, 2, 3, 4, 10, 11)) == list(range(105, 112))
    again = assign_keys(spark.range(0, 12).toDF("n"), ["n"], "k", existing=second)
    assert {r.n: r.k for r in again.collect()} == got


def test_an_empty_mark_starts_at_the_start(spark):
    none = spark.createDataFrame([], "k long, n long")
    keyed = assign_keys(spark.range(3).toDF("n"), ["n"], "k", existing=none, start=7)
    assert numbers(keyed) == [7, 8, 9]


def test_rows_numbered_as_they_arrive_need_no_shuffle(spark):
    rows = spark.range(0, 500, 1, 6).select(F.lit("same").alias("x"))
    keyed = number_rows(rows, "k")
    assert keyed.columns == ["k", "x"]
    assert numbers(keyed) == list(range(1, 501))


def test_many_copies_of_a_row_spread_over_tasks_and_stay_in_order(spark, conf, monkeypatch):
    tables = []
    monkeypatch.setattr(keys, "write_scratch", lambda *a: tables.append(write_scratch(*a)) or tables[-1])
    conf(spark__sql__adaptive__enabled="false", spark__sql__shuffle__partitions="6")
    hot = F.when(F.col("id") % 3 == 0, 50_000).otherwise(F.col("id"))
    rows = spark.range(0, 60_000, 1, 5).select(hot.alias("n"))
    keyed = number_rows(rows, "k", ["n"])
    assert numbers(keyed) == list(range(1, 60_001))
    in_order = [r.n for r in keyed.orderBy("k").collect()]
    assert in_order == sorted(in_order)
    assert [spark.catalog.tableExists(t) for t in tables] == [False, True]
    written = spark.table(tables[-1]).filter("n = 50000")
    assert written.count() == 20_001
    assert written.select("__part").distinct().count() > 1


def test_numbering_twice_reads_the_same_numbers(spark):
    keyed = number_rows(spark.range(100).withColumn("r", F.rand()).repartition(5), "k")
    first = {r.id: r.k for r in keyed.collect()}
    assert {r.id: r.k for r in keyed.collect()} == first


def test_nothing_to_number(spark):
    assert assign_keys(spark.range(0).toDF("n"), ["n"], "k").collect() == []


def test_scratch_tables_can_be_released(spark):
    table = write_scratch(spark.range(3), "rows")
    assert spark.table(table).count() == 3
    release_scratch(spark)
    release_scratch(spark)
    assert not spark.catalog.tableExists(table)
    assert numbers(number_rows(spark.range(3), "k")) == [1, 2, 3]


def test_a_dimension_with_a_repeated_key_is_refused(spark):
    from orrery.plans.warehouse import keyed_dimension

    rows = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    with pytest.raises(ValueError, match=r"\(1, 2\)"):
        keyed_dimension(rows, ["k"], "key")
    assert sorted(tuple(r) for r in keyed_dimension(rows.distinct(), ["k"], "key").collect()) == [(1, 1), (2, 2)]
