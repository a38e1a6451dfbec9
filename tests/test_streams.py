from __future__ import annotations

import json
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orrery.models import staff
from orrery.operators.gold import gold_avg_by_group
from orrery.operators.joins import Dim
from orrery.operators.preview import preview_stream
from orrery.plans.feeds import land_json_arrays, land_json_lines
from orrery.plans.warehouse import land_dates, land_dimensions, rebuild, take_in
from orrery.sinks.catalog import show_tables
from orrery.sources.files import hinted_schema
from orrery.streaming.medallion import (
    append_stream, bronze, dims_of, gold_rows, quarantine, read_feed, replay, silver,
    with_identity,
)
from tests import staff_rows

STAR = staff.STAR


def person(employee_id: int, **changes) -> dict:
    return {
        "employee_id": employee_id, "first_name": "Ann", "last_name": "Fox",
        "email": "ann@example.org", "phone_number": None, "hire_date": "1999-01-31", "job_id": 1,
        "salary": 2500.10, "manager_id": None, "department_id": 1, **changes,
    }


def drop(folder, name: str, *documents: dict) -> None:
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(json.dumps(list(documents), indent=1))


def run_bronze(spark, place, folder, **options):
    table = place.table("fact_bronze")
    bronze(spark, str(folder), staff.EMPLOYEES.schema, table, place.checkpoint("bronze"), **options)
    return spark.table(table)


def ids(df, column="employee_id"):
    return sorted(r[column] for r in df.collect())


def test_bronze_types_its_rows_and_notes_their_origin(spark, place, tmp_path):
    drop(tmp_path / "in", "a.json", person(1), person(2, manager_id=1))
    rows = {r.employee_id: r for r in run_bronze(spark, place, tmp_path / "in").collect()}
    assert rows[2].salary == Decimal("2500.10") and rows[2].hire_date == date(1999, 1, 31)
    assert (rows[1].manager_id, rows[2].manager_id) == (None, 1)
    assert rows[1].source_file.endswith("/in/a.json") and rows[1].ingest_ts is not None
    assert rows[1].rescued is None


def test_one_bad_value_spoils_neither_its_row_nor_its_file(spark, place, tmp_path):
    drop(tmp_path / "in", "a.json",
         person(1), person(2, hire_date="31.1.1999", salary="lots"), person(3, nickname="extra"))
    short = person(4)
    del short["email"], short["salary"]
    drop(tmp_path / "in", "b.json", short)
    rows = {r.employee_id: r for r in run_bronze(spark, place, tmp_path / "in").collect()}
    assert sorted(rows) == [1, 2, 3, 4]
    assert (rows[2].hire_date, rows[2].salary, rows[2].last_name) == (None, None, "Fox")
    assert json.loads(rows[2].rescued) == {"hire_date": "31.1.1999", "salary": "lots"}
    assert json.loads(rows[3].rescued) == {"nickname": "extra"}
    assert rows[4].rescued is None and rows[4].email is None


def test_documents_by_line_are_taken_in_alike(spark, place, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    lines = [json.dumps(person(1)), json.dumps(person(2, salary="lots", phone_number=5)), "{oops"]
    (folder / "a.json").write_text("\n".join(lines))
    rows = run_bronze(spark, place, folder, multi_line=False).orderBy("employee_id").collect()
    assert [(r.employee_id, r.salary, r.phone_number, r.rescued) for r in rows] == [
        (None, None, None, "{oops"),
        (1, Decimal("2500.10"), None, None),
        (2, None, "5", '{"salary":"lots"}'),
    ]


def test_nested_fields_of_an_inferred_schema(spark, place, tmp_path):
    drop(tmp_path / "in", "a.json", {"id": 1, "at": {"x": 1.5, "tags": ["a", "b"]}, "list": [1, 2]})
    schema = hinted_schema(spark, str(tmp_path / "in"), {}, f"{place.root}/schema")
    table = place.table("nested")
    bronze(spark, str(tmp_path / "in"), schema, table, place.checkpoint("nested"))
    row = spark.table(table).first()
    assert (row.id, row["at"].x, row["at"].tags, row["list"]) == (1, 1.5, ["a", "b"], [1, 2])


def test_a_malformed_file_is_kept_as_text(spark, place, tmp_path):
    drop(tmp_path / "in", "a.json", person(1))
    (tmp_path / "in" / "b.json").write_text('[{"employee_id": 2}, {"employee')
    rows = run_bronze(spark, place, tmp_path / "in").orderBy("employee_id").collect()
    assert [(r.employee_id, r.rescued) for r in rows] == [
        (None, '[{"employee_id": 2}, {"employee'), (1, None)
    ]


def test_dates_grow_with_the_facts(spark, place):
    def facts(*days):
        return spark.createDataFrame([(date.fromisoformat(d),) for d in days], "hire_date date")

    assert land_dates(STAR, place, facts("1999-12-30", "2000-01-02")).count() == 4
    dates = land_dates(STAR, place, facts("1999-12-31", "2000-01-05"))
    assert ids(dates, "date_key")[-1] == 20000105 and dates.count() == 7
    assert land_dates(STAR, place, facts("2000-01-05")).count() == 7


def test_each_file_is_taken_once_even_if_it_is_rewritten(spark, place, tmp_path):
    folder = tmp_path / "in"
    drop(folder, "a.json", person(1))
    drop(folder, "b.json", person(2))
    assert ids(run_bronze(spark, place, folder, max_files=1)) == [1, 2]
    assert ids(run_bronze(spark, place, folder)) == [1, 2]
    drop(folder, "c.json", person(3))
    drop(folder, "a.json", person(9))
    assert ids(run_bronze(spark, place, folder)) == [1, 2, 3]


def test_a_running_query_takes_files_as_they_come(spark, place, tmp_path):
    folder, table = tmp_path / "in", place.table("fact_bronze")
    drop(folder, "a.json", person(1))
    query = bronze(spark, str(folder), staff.EMPLOYEES.schema, table,
                   place.checkpoint("bronze"), available_now=False)
    try:
        query.processAllAvailable()
        drop(folder, "b.json", person(2))
        query.processAllAvailable()
        assert ids(spark.table(table)) == [1, 2]
    finally:
        query.stop()


@pytest.fixture
def hr(spark):
    return staff_rows.tables(spark)


def feed_of(hr, tmp_path, condition="true"):
    folder = str(tmp_path / "feed")
    land_json_arrays(hr["employees"].filter(condition), folder)
    return folder


def test_silver_holds_the_rows_with_all_their_dimensions(spark, place, hr, tmp_path):
    tables = land_dimensions(spark, STAR, place, hr)
    rows = take_in(spark, STAR, place, feed_of(hr, tmp_path), tables)
    assert rows.columns == [
        "employee_key", "job_key", "department_key", "location_key", "hire_date", "salary"
    ]
    # 104's department has no location, 105 has no department
    assert sorted((r.employee_key, r.job_key, r.department_key, r.location_key)
                  for r in rows.collect()) == [
        (100, 4, 2, 20), (101, 1, 1, 10), (102, 1, 1, 10), (103, 3, 2, 20)
    ]
    waiting = quarantine(spark.table(place.table("fact_bronze")), dims_of(STAR.hops, tables))
    assert sorted((r.employee_id, r.missing) for r in waiting.collect()) == [
        (104, [2]), (105, [1, 2])
    ]


def test_streaming_in_parts_equals_streaming_at_once(spark, place, hr, tmp_path):
    tables = land_dimensions(spark, STAR, place, hr)
    feed = feed_of(hr, tmp_path, "employee_id < 102")
    assert ids(take_in(spark, STAR, place, feed, tables), "employee_key") == [100, 101]
    feed_of(hr, tmp_path, "employee_id >= 102")
    for _ in range(2):
        rows = take_in(spark, STAR, place, feed, tables, max_files=1)
        assert ids(rows, "employee_key") == [100, 101, 102, 103]


def test_a_dimension_row_that_came_late(spark, place, hr, tmp_path):
    early = {**hr, "jobs": hr["jobs"].filter("job_id <> 1")}
    tables = land_dimensions(spark, STAR, place, early)
    rows = take_in(spark, STAR, place, feed_of(hr, tmp_path), tables)
    assert ids(rows, "employee_key") == [100, 103]
    tables = land_dimensions(spark, STAR, place, hr)
    for _ in range(2):
        everything = replay(
            spark.table(place.table("fact_bronze")), place.room(), dims_of(STAR.hops, tables), with_identity(STAR.silver)
        )
        assert ids(everything, "employee_key") == [100, 101, 102, 103]


def test_rebuild_reports_the_bands_and_leaves_old_tables_behind(spark, place, hr, tmp_path):
    spark.range(1).write.saveAsTable(place.table("stale"))
    place, report = rebuild(spark, STAR, place, hr, feed_of(hr, tmp_path))
    assert report.columns == ["job_title", "avg_min_salary", "avg_max_salary"]
    # two jobs are titled Clerk: job 1 has 2 · 2 joined rows, job 3 has 1 · 1
    assert [tuple(r) for r in report.collect()] == [
        ("Director", None, 40000.0),
        ("Clerk", pytest.approx((4 * 2000 + 3000) / 5), pytest.approx((4 * 5000 + 6000) / 5)),
    ]
    names = {r.tableName for r in show_tables(spark, place.database).collect()}
    assert names == {
        "dim_jobs", "dim_employees", "dim_departments", "dim_locations", "fact_bronze",
        "fact_silver", "fact_waiting", "fact_gold", "dim_date", "fact",
        "gold_state", "violations",
    }


def test_fan_out_of_the_whole_staff(spark, place, hr):
    """Each job counts its fact rows times its employees."""
    tables = land_dimensions(spark, STAR, place, hr)
    people = tables["dim_employees"]
    joined = people.alias("f").join(people.alias("e"), "job_key").join(tables["dim_jobs"], "job_key")
    assert joined.count() == 1 + 2 * 2 + 1 + 2 * 2
    plain = joined.groupBy("job_title").agg(F.avg("min_salary").cast("double").alias("a"))
    got = gold_rows(people, tables, STAR.gold)
    assert {r.job_title: r.avg_min_salary for r in got.collect()} == pytest.approx(
        {r.job_title: r.a for r in plain.collect()}, abs=1e-5
    )


def test_a_hot_key_of_the_stream_is_split(spark, place, conf, capsys):
    """A dimension too large to broadcast is shuffled, and the adaptive join splits the key."""
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="1b",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="16k",
    )
    shop = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("shop")
    spark.range(60_000).select("id", shop).repartition(6).write.saveAsTable(place.table("sales"))
    dims = [Dim(spark.range(60_000).select(F.col("id").alias("shop")), {"shop": "shop"})]
    query = silver(spark, place.table("sales"), dims, {"id": "id"}, place.table("out"),
                   place.checkpoint("out"))
    query.explain()
    assert "SortMergeJoin(skew=true)" in capsys.readouterr().out
    assert spark.table(place.table("out")).count() == 60_000


def test_stream_preview_shows_some_rows_of_the_feed(spark, hr, tmp_path):
    feed = read_feed(spark, feed_of(hr, tmp_path), staff.EMPLOYEES.schema)
    assert preview_stream(feed, 4).count() == 4
    assert preview_stream(feed, 50).count() == 6


def test_a_preview_reads_no_more_files_than_it_takes(spark, tmp_path):
    for n in range(6):
        drop(tmp_path / "in", f"{n}.json", person(2 * n), person(2 * n + 1))
    feed = read_feed(spark, str(tmp_path / "in"), staff.EMPLOYEES.schema, max_files=1)
    shown = preview_stream(feed, 3)
    assert shown.count() == 3 and shown.select("source_file").distinct().count() == 2
    assert len({f.rsplit("/", 2)[1] for f in shown.inputFiles()}) == 2
    assert preview_stream(feed.where("false"), 3).collect() == []


def test_a_view_over_a_stream_stays_a_stream(spark, place, hr, tmp_path):
    read_feed(spark, feed_of(hr, tmp_path), staff.EMPLOYEES.schema).createOrReplaceTempView("raw_v")
    view = spark.sql("SELECT employee_id, last_name AS name FROM raw_v")
    assert view.isStreaming
    append_stream(view, place.table("names"), place.checkpoint("names"))
    assert spark.table(place.table("names")).count() == 6


def test_gold_ignores_facts_without_a_key(spark):
    fact = spark.createDataFrame([(1, 2.0), (None, 9.0)], "k int, x double")
    other = spark.createDataFrame([(1, "t"), (None, "u")], "k int, title string")
    rows = gold_avg_by_group(fact, other, other, ("k", "k", "k"), "title", {"a": ("fact", "x")})
    assert [tuple(r) for r in rows.collect()] == [("t", 2.0)]


def test_old_dated_files_are_taken_in(spark, tmp_path):
    import os
    import time

    from pyspark.sql import types as T

    from orrery.streaming.medallion import read_feed

    folder, schema = tmp_path / "feed", T.StructType().add("n", T.IntegerType())
    folder.mkdir()
    for n, days in ((1, 0), (2, 30), (3, 0)):
        (folder / f"{n}.json").write_text(f'{{"n": {n}}}')
        os.utime(folder / f"{n}.json", (time.time() - days * 86400 + n,) * 2)
        stream = read_feed(spark, str(folder), schema, multi_line=False).select(F.col("n").cast("string"))
        query = stream.writeStream.format("parquet").option("path", str(tmp_path / "out"))
        query.option("checkpointLocation", str(tmp_path / "at")).trigger(availableNow=True).start().awaitTermination()
    assert sorted(r["n"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["1", "2", "3"]


def test_silver_is_handed_only_the_columns_it_needs(spark, place, hr, tmp_path, monkeypatch):
    from orrery.streaming import medallion

    handed, split = [], medallion._split

    def noted(session, rows, *rest):
        handed.append(set(rows.columns))
        split(session, rows, *rest)

    monkeypatch.setattr(medallion, "_split", noted)
    rows = take_in(spark, STAR, place, feed_of(hr, tmp_path), land_dimensions(spark, STAR, place, hr))
    assert rows.count() > 0 and len(handed) == 1
    assert {"batch_id", "row_id", "job_id"} <= handed[0] and not handed[0] & {"document", "rescued", "email"}


def test_a_feed_of_lines_lands_compressed_in_bounded_files(spark, place, hr, tmp_path):
    folder, people = tmp_path / "in", hr["employees"].crossJoin(spark.range(500).select((F.col("id") * 1000).alias("more")))
    people = people.withColumn("employee_id", (F.col("employee_id") + F.col("more")).cast("int")).drop("more").coalesce(1)
    land_json_lines(people, str(folder), file_rows=1100)
    sizes = [spark.read.text(str(f)).count() for f in folder.glob("part-*")]
    assert sum(sizes) == people.count() and len(sizes) >= 3 and max(sizes) <= 1100
    plain = spark.read.text(str(folder)).agg(F.sum(F.octet_length("value") + 1)).first()[0]
    assert sum(f.stat().st_size for f in folder.glob("part-*")) < plain / 4
    rows = run_bronze(spark, place, folder, multi_line=False)
    assert ids(rows) == ids(people)


def test_the_feed_of_late_lines_takes_less_disk_than_its_text(spark, tmp_path, monkeypatch):
    """``silver_replay_lines`` over rows of its own: each arrives once, and its feed is stored compressed."""
    from pathlib import Path

    from orrery.queries import streams

    lines = spark.range(4000).selectExpr(
        "id AS l_orderkey", "id % 7 AS l_partkey", "id % 6 AS l_suppkey", "cast(id % 3 AS int) AS l_linenumber",
        "cast(id % 50 AS double) AS l_quantity", "id * 1.25D AS l_extendedprice", "0.01D AS l_discount", "0.02D AS l_tax",
        "'N' AS l_returnflag", "'O' AS l_linestatus", "timestamp_ntz'1996-09-13 00:00:00' AS l_shipdate",
    )
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(6).selectExpr(
        "id AS s_suppkey", "concat('s', id) AS s_name", "cast(id AS int) AS s_nationkey", "1.0D AS s_acctbal"
    ).write.parquet(f"{tmp_path}/supplier.parquet")
    spark.range(7).selectExpr(
        "id AS p_partkey", "concat('p', id) AS p_name", "'b' AS p_brand", "'t' AS p_type", "1 AS p_size", "1.0D AS p_retailprice"
    ).write.parquet(f"{tmp_path}/part.parquet")
    feeds, take = set(), streams.take_in

    def noted(session, star, place, feed, *rest, **options):
        feeds.add(feed)
        return take(session, star, place, feed, *rest, **options)

    monkeypatch.setattr(streams, "take_in", noted)
    rows = streams.silver_replay_lines(spark, str(tmp_path)).groupBy("came_late").agg(
        F.count("*"), F.countDistinct("order_key")
    ).collect()
    late = sum(n % 6 % 3 == 0 for n in range(4000))
    assert {tuple(r) for r in rows} == {(True, late, late), (False, 4000 - late, 4000 - late)}
    (feed,) = feeds
    text = spark.read.text(feed).agg(F.sum(F.octet_length("value") + 1)).first()[0]
    assert sum(f.stat().st_size for f in Path(feed).glob("part-*")) < text / 4
