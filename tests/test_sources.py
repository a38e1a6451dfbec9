from __future__ import annotations

import json
from datetime import date
from decimal import Decimal
from unittest.mock import MagicMock

import pytest
from pyspark.sql import types as T

from orrery.models import staff
from orrery.operators.conform import conform
from orrery.plans.feeds import land_json_arrays
from orrery.session import scratch, shared_root
from orrery.sources import files, jdbc
from orrery.sources.collections import load_collections, scan

CSV = """location_id,street_address,postal_code,city,state_province,country_id
10,"1 Hill Road",X1Y 2Z3,Ashby,NULL,AA
20,"Unit 2, Low Street",00123,"Great Borley",Kent,BB
30,"The ""Old"" Mill",NULL,Corby,NULL,AA
"""


@pytest.fixture
def csv_file(tmp_path):
    path = tmp_path / "locations.csv"
    path.write_text(CSV)
    return str(path)


def test_csv_quotes_commas_and_null_literal(spark, csv_file):
    rows = {r.location_id: r for r in files.read_csv(spark, csv_file).collect()}
    assert rows[20].street_address == "Unit 2, Low Street"
    assert rows[30].street_address == 'The "Old" Mill'
    assert (rows[10].postal_code, rows[30].postal_code) == ("X1Y 2Z3", None)
    assert rows[10].state_province is None


def test_csv_null_literal_does_not_spoil_a_number_column(spark, tmp_path):
    path = tmp_path / "people.csv"
    path.write_text("id,manager,hired,pay\n1,NULL,1999-08-31,10.50\n2,1,2000-02-29,11.00\n")
    frame = files.read_csv(spark, str(path))
    assert [f.dataType for f in frame.schema] == [
        T.IntegerType(), T.IntegerType(), T.DateType(), T.DoubleType()
    ]


def test_csv_with_a_declared_schema(spark, csv_file):
    frame = files.read_csv(spark, csv_file, staff.LOCATIONS.schema)
    assert frame.filter("location_id = 20").first().postal_code == "00123"


def test_json_array_over_many_lines(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"id": 1, "x": None}, {"id": 2}], indent=2))
    rows = files.read_json(spark, str(tmp_path)).collect()
    assert sorted(r.id for r in rows) == [1, 2]


def test_a_malformed_document_fails_the_read(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"id": 1}, {"id": ')
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        files.read_json(spark, str(tmp_path), T.StructType().add("id", "long")).collect()


def test_text_fields_take_numbers_as_text(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"code": "00123"}, {"code": 45}, {"code": null}, {}]')
    schema = T.StructType().add("code", "string")
    rows = files.read_json(spark, str(tmp_path), schema).collect()
    assert [r.code for r in rows] == ["00123", "45", None, None]


def test_json_lines_when_asked(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id": 1}\n{"id": 2}\n')
    assert files.read_json(spark, str(tmp_path), multi_line=False).count() == 2


def test_hints_override_inference_and_the_schema_is_kept(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"id": 1, "pay": 2.5, "hired": "2000-02-29"}]')
    kept = scratch(spark, "schema")
    hints = {"pay": T.DecimalType(8, 2), "hired": T.DateType(), "note": T.StringType()}
    schema = files.hinted_schema(spark, str(tmp_path), hints, kept)
    assert schema["id"].dataType == T.LongType()
    row = files.read_json(spark, str(tmp_path), schema).first()
    assert (row.pay, row.hired, row.note) == (Decimal("2.50"), date(2000, 2, 29), None)
    (tmp_path / "b.json").write_text('[{"id": "text now", "other": 1}]')
    assert files.hinted_schema(spark, str(tmp_path), {}, kept) == schema
    assert files.load_schema(spark, scratch(spark, "never-written")) is None


def test_listing_does_not_read_contents(spark, tmp_path):
    (tmp_path / "deep").mkdir()
    (tmp_path / "a.csv").write_text("abc")
    (tmp_path / "deep" / "b.csv").write_text("abcde")
    (tmp_path / "c.json").write_text("[]")
    listed = files.list_files(spark, str(tmp_path), "*.csv")
    assert listed.columns == ["path", "modificationTime", "length"]
    assert sorted((r.path.rsplit("/", 1)[1], r.length) for r in listed.collect()) == [
        ("a.csv", 3), ("b.csv", 5)
    ]


def test_landed_arrays_are_valid_json_and_complete(spark, tmp_path):
    folder = str(tmp_path / "feed")
    rows = [(i, None if i % 2 else f"a\n\"{i}\"") for i in range(25)]
    frame = spark.createDataFrame(rows, "i int, s string")
    land_json_arrays(frame, folder, file_bytes=100)
    land_json_arrays(frame.limit(1), folder)
    arrays = [json.loads(p.read_text()) for p in (tmp_path / "feed").glob("part-*")]
    assert sum(map(len, arrays)) == 26
    assert all("s" in document for array in arrays for document in array)
    assert files.read_json(spark, folder, frame.schema).distinct().count() == 25


def test_collections_are_replaced_and_counted(spark, place, tmp_path):
    (tmp_path / "d.json").write_text('[{"id": 1, "name": "x"},\n {"id": 2, "name": null}]')
    given = {"departments": str(tmp_path / "d.json")}
    assert load_collections(spark, place.database, given) == {"departments": 2}
    assert load_collections(spark, place.database, given) == {"departments": 2}
    assert scan(spark, place.database, "departments").count() == 2
    assert load_collections(spark, place.database, {}) == {}


def test_conform_types_orders_and_fills_columns(spark):
    raw = spark.createDataFrame(
        [("7", "Clerk", "2000.005", "x", 1)],
        "job_id string, job_title string, min_salary string, max_salary string, extra int",
    )
    frame = conform(raw.drop("max_salary"), staff.JOBS)
    assert frame.schema == staff.JOBS.schema
    row = conform(raw, staff.JOBS).first()
    assert (row.job_id, row.min_salary, row.max_salary) == (7, Decimal("2000.01"), None)


# No database may be started here, so the JDBC scans are checked up to the call into Spark.


def test_a_query_takes_the_place_of_a_table():
    assert jdbc.as_table("jobs") == "jobs"
    assert jdbc.as_table("hr.v_jobs") == "hr.v_jobs"
    assert jdbc.as_table("select\t1") == "(select\t1) q"
    assert jdbc.as_table("(select 1)") == "(select 1) q"
    assert jdbc.as_table("SELECT * FROM jobs;") == "(SELECT * FROM jobs) q"
    assert jdbc.as_table(" with j as (select 1) select * from j") == (
        "(with j as (select 1) select * from j) q"
    )
    assert jdbc.mysql_url("db.example.org", 3306, "hr") == "jdbc:mysql://db.example.org:3306/hr"


def test_jdbc_scan_is_split_where_asked():
    spark, properties = MagicMock(), {"user": "u", "driver": "d"}
    jdbc.scan_query(spark, "jdbc:x", "select 1", properties)
    spark.read.jdbc.assert_called_with("jdbc:x", "(select 1) q", properties=properties)
    jdbc.scan_query(spark, "jdbc:x", "jobs", properties, split=jdbc.Split("id", 1, 9, 4))
    spark.read.format.assert_called_with("jdbc")
    spark.read.format.return_value.options.assert_called_with(
        url="jdbc:x", dbtable="jobs", partitionColumn="id", lowerBound="1", upperBound="9", numPartitions="4",
        **properties,
    )
    days = jdbc.Split("hired", date(1999, 1, 31), date(2000, 2, 29), 4)
    jdbc.scan_query(spark, "jdbc:x", "jobs", properties, split=days)
    given = spark.read.format.return_value.options.call_args.kwargs
    assert (given["lowerBound"], given["upperBound"]) == ("1999-01-31", "2000-02-29")
    jdbc.scan_query(spark, "jdbc:x", "jobs", properties, predicates=["id < 5", "id >= 5"])
    spark.read.jdbc.assert_called_with(
        "jdbc:x", "jobs", predicates=["id < 5", "id >= 5"], properties=properties
    )


def test_jdbc_range_is_asked_of_the_database():
    spark = MagicMock()
    spark.read.jdbc.return_value.first.return_value = (3, 88)
    assert jdbc.key_range(spark, "jdbc:x", "jobs", "job_id", 8, {}) == jdbc.Split("job_id", 3, 88, 8)
    assert spark.read.jdbc.call_args.args[1] == (
        "(select min(job_id) as lo, max(job_id) as hi from jobs) b"
    )
    spark.read.jdbc.return_value.first.return_value = (None, None)
    assert jdbc.key_range(spark, "jdbc:x", "jobs", "job_id", 8, {}) is None


def test_jdbc_view_quotes_its_options():
    spark = MagicMock()
    jdbc.create_view(spark, "view_jobs", "jdbc:x", "hr.v_jobs", user="o'brien", fetchsize="1000")
    spark.sql.assert_called_with(
        "CREATE OR REPLACE TEMPORARY VIEW view_jobs USING org.apache.spark.sql.jdbc OPTIONS "
        "(`url` 'jdbc:x', `dbtable` 'hr.v_jobs', `user` 'o\\'brien', `fetchsize` '1000')"
    )


def test_scratch_stays_below_the_shared_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert scratch(spark, "x").startswith(shared_root(spark) + "/")
    if named:
        assert shared_root(spark) == named.rstrip("/")


def test_a_cluster_without_a_shared_folder_is_refused():
    spark = MagicMock()
    spark.conf.get.return_value = None
    spark.sparkContext.master = "yarn"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_root(spark)


def test_the_ledger_tells_files_apart(spark, place, tmp_path):
    import json
    import os
    import time

    from orrery.models import staff
    from orrery.sources.ledger import file_states, note_files
    from orrery.streaming.medallion import bronze
    from tests.test_streams import person

    folder, ledger, table = tmp_path / "in", place.table("files"), place.table("fact_bronze")
    folder.mkdir()
    write = lambda name, *rows: (folder / name).write_text(json.dumps(list(rows)))

    def states():
        note_files(spark, str(folder), ledger)
        found = file_states(spark, ledger, spark.table(table)).collect()
        return {r["path"].rsplit("/", 1)[1]: (r["state"], r["n_rows"], r["first_look"], r["last_look"]) for r in found}

    write("a.json", person(1), person(2))
    write("b.json", person(3))
    write("empty.json")
    note_files(spark, str(folder), ledger)
    bronze(spark, str(folder), staff.EMPLOYEES.schema, table, place.checkpoint("bronze"))
    assert states() == {"a.json": ("taken", 2, 1, 2), "b.json": ("taken", 1, 1, 2), "empty.json": ("skipped", 0, 1, 2)}
    write("a.json", person(1), person(9), person(10))
    os.remove(folder / "b.json")
    write("c.json", person(4))
    assert states() == {
        "a.json": ("rewritten", 2, 1, 3), "b.json": ("vanished", 1, 1, 2), "c.json": ("skipped", 0, 3, 3), "empty.json": ("skipped", 0, 1, 3),
    }
    bronze(spark, str(folder), staff.EMPLOYEES.schema, table, place.checkpoint("bronze"))
    write("late.json", person(5))
    time.sleep(0.01)
    bronze(spark, str(folder), staff.EMPLOYEES.schema, table, place.checkpoint("bronze"))
    assert states()["c.json"] == ("taken", 1, 3, 4) and states()["late.json"] == ("taken", 1, 4, 5)


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_a_csv_value_that_does_not_fit_fails_in_any_mode(spark, conf, tmp_path, ansi):
    conf(spark__sql__ansi__enabled=ansi)
    (tmp_path / "a.csv").write_text("day,n\n1999-01-31,1\n1999-01-31T10:00:00,2\n")
    (tmp_path / "b.csv").write_text("n,day\nNULL,1999-01-31\n")
    schema = "day date, n int"
    from orrery.sources.files import read_csv
    from pyspark.sql.types import StructType

    assert read_csv(spark, str(tmp_path / "b.csv"), StructType.fromDDL(schema)).first().n is None
    with pytest.raises(Exception, match="column day is no date"):
        read_csv(spark, str(tmp_path / "a.csv"), StructType.fromDDL(schema)).collect()


def _generates(plan):
    below = [g for i in range(plan.children().size()) for g in _generates(plan.children().apply(i))]
    return [plan, *below] if plan.nodeName() == "Generate" else below


def test_only_malformed_texts_go_along_with_the_documents_of_an_array(spark):
    from orrery.sources.documents import parse_documents

    texts = ['[{"a": 1}, null, {"a": 2}]', "[]", "", '{"a": 3}', '[{"a": 4}']
    pieces = spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "value string, file int")
    found = parse_documents(pieces, "value", multi_line=True)
    rows = sorted((r.file, r.f or "", r.malformed or "") for r in found.selectExpr("file", "to_json(fields) AS f", "malformed").collect())
    assert rows == [(0, "", texts[0]), (0, '{"a":1}', ""), (0, '{"a":2}', ""), (3, '{"a":3}', ""), (4, "", texts[4])]
    (made,) = _generates(found._jdf.queryExecution().optimizedPlan())
    assert [made.output().apply(i).name() for i in range(made.output().size())] == ["file", "fields", "malformed"]


def test_a_large_year_of_a_feed_comes_as_several_files(spark, conf, tmp_path, monkeypatch):
    from __spark_entry__ import queries

    conf(
        spark__sql__adaptive__advisoryPartitionSizeInBytes="2k",
        spark__sql__adaptive__coalescePartitions__enabled="false",
    )
    days = "timestamp_ntz'1996-01-01' + make_dt_interval(cast(id % 1000 AS int)) AS o_orderdate"
    orders = spark.range(0, 4000, 1, 4).selectExpr(
        "id AS o_orderkey", "id % 7 AS o_custkey", "'F' AS o_orderstatus", "1.5D AS o_totalprice", days, "'1-URGENT' AS o_orderpriority"
    )
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    folders = {}

    def noted(spark, purpose):
        folders[purpose] = scratch(spark, purpose)
        return folders[purpose]

    monkeypatch.setattr("orrery.queries.sources.scratch", noted)
    states = {(r.order_year, r.state, r.n_rows, r.first_look) for r in queries()["feed_ledger"](spark, str(tmp_path)).collect()}
    assert states == {
        (1996, "rewritten", 1464, 1), (1997, "vanished", 1460, 1), (1998, "taken", 1076, 1), (9999, "skipped", 0, 2)
    }
    for year in (1996, 1998):
        assert len([f for f in files.list_files(spark, folders["feed"], "*.json").collect() if f"y={year}/" in f.path]) > 1
