from __future__ import annotations

from uuid import uuid4

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from orrery.operators.preview import preview
from orrery.session import scratch
from orrery.sinks import catalog


def test_database_is_created_once_and_dropped_with_its_tables(spark):
    name = f"db_{uuid4().hex}"
    catalog.create_database(spark, name, scratch(spark, "db"), "it's", {"purpose": "a 'test'"})
    catalog.create_database(spark, name, scratch(spark, "db"), "another")
    said = {r.info_name: r.info_value for r in catalog.describe_database(spark, name).collect()}
    assert said["Comment"] == "it's"
    assert said["Properties"] == "((purpose,a 'test'))"
    catalog.overwrite_table(spark.range(3).toDF("id"), f"{name}.t")
    catalog.drop_database(spark, name)
    catalog.drop_database(spark, name)
    assert not spark.catalog.databaseExists(name)


def test_create_as_leaves_an_existing_table_alone(spark, place):
    table = place.table("dim")
    catalog.create_table_as(spark, table, spark.range(3).toDF("id"), f"{place.root}/dim", "it's")
    catalog.create_table_as(spark, table, spark.range(9).toDF("other"), f"{place.root}/dim")
    assert spark.table(table).columns == ["id"]
    assert spark.table(table).count() == 3
    said = {r.col_name: r.data_type for r in catalog.describe_table(spark, table).collect()}
    assert (said["Comment"], said["Type"]) == ("it's", "EXTERNAL")
    assert said["Location"].endswith("/dim")


def test_overwrite_replaces_rows_and_schema(spark, place):
    table = place.table("dim")
    catalog.overwrite_table(spark.range(3).toDF("id"), table)
    catalog.overwrite_table(spark.range(2).select(F.lit("x").alias("name")), table)
    assert [r.name for r in spark.table(table).collect()] == ["x", "x"]


def test_inserts_append_by_column_name(spark, place):
    table = place.table("t")
    rows = spark.createDataFrame([(1, "a")], "id int, name string")
    catalog.create_table(spark, table, rows)
    assert spark.table(table).count() == 0
    catalog.insert_rows(rows, table)
    catalog.insert_rows(rows.select("name", "id"), table)
    assert [tuple(r) for r in spark.table(table).collect()] == [(1, "a"), (1, "a")]
    with pytest.raises(AnalysisException):
        catalog.insert_rows(rows.drop("name"), table)


def test_tables_and_views_are_listed_and_described(spark, place):
    catalog.overwrite_table(spark.range(1).toDF("id"), place.table("one"))
    view = f"v_{uuid4().hex}"
    spark.range(1).select(F.current_date().alias("d")).createOrReplaceTempView(view)
    assert [r.tableName for r in catalog.show_tables(spark, place.database).collect()] == ["one"]
    described = catalog.describe_table(spark, view).collect()
    assert [(r.col_name, r.data_type) for r in described[:1]] == [("d", "date")]


def test_tables_in_equal_buckets_join_without_a_shuffle(spark, place, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    for name in ("a", "b"):
        catalog.overwrite_table(
            spark.range(1000).toDF("id"), place.table(name), bucket_by=(4, "id")
        )
    joined = spark.table(place.table("a")).join(spark.table(place.table("b")), "id")
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == 1000


def test_preview_keeps_the_first_rows(spark):
    rows = spark.range(100).select((99 - F.col("id")).alias("n"))
    assert [r.n for r in preview(rows, 5, ["n"]).collect()] == [0, 1, 2, 3, 4]
