"""Rows known by their identity: late dimensions, repeated runs, rescued fields, versions of a schema."""

from __future__ import annotations

import json
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orrery.functions.casts import changed_by_cast, exact
from orrery.models import staff
from orrery.models.table import DATE, TEXT, Field, Table, money
from orrery.operators.audits import audit_types
from orrery.plans.warehouse import facts, land_dimensions, take_in
from orrery.sinks.catalog import overwrite_partition
from orrery.sources.documents import current_version, variant_schema, versions
from orrery.streaming import medallion
from orrery.streaming.medallion import (
    as_version, bronze, dims_of, evolve, release, replay, with_identity,
)
from tests import staff_rows
from tests.test_streams import drop, person

STAR = staff.STAR


@pytest.fixture
def hr(spark):
    return staff_rows.tables(spark)


@pytest.fixture
def late_jobs(spark, place, hr, tmp_path):
    """Employee 5 twice, with a job that is there and one that is not; the same without a key; and one row twice."""
    drop(tmp_path / "in", "a.json",
         person(5, job_id=1), person(5, job_id=2), person(None, job_id=1), person(None, job_id=2),
         person(6, job_id=2), person(6, job_id=2))
    early = land_dimensions(spark, STAR, place, {**hr, "jobs": hr["jobs"].filter("job_id <> 2")})
    assert take_in(spark, STAR, place, str(tmp_path / "in"), early).count() == 2
    return early, lambda: land_dimensions(spark, STAR, place, hr)


WANTED = Counter({(5, 1): 1, (5, 2): 1, (None, 1): 1, (None, 2): 1, (6, 2): 2})


def held(rows) -> Counter:
    return Counter((r.employee_key, r.job_key) for r in rows.collect())


def again(spark, place, tables):
    return release(spark, place.room(), dims_of(STAR.hops, tables), with_identity(STAR.silver))


def test_null_and_repeated_keys_arrive_exactly_once(spark, place, late_jobs, tmp_path):
    early, land = late_jobs
    assert held(again(spark, place, early)) == Counter({(5, 1): 1, (None, 1): 1})
    tables = land()
    for _ in range(3):
        assert held(take_in(spark, STAR, place, str(tmp_path / "in"), tables, late=True)) == WANTED
        assert held(replay(
            spark.table(place.table("fact_bronze")), place.room(), dims_of(STAR.hops, tables), with_identity(STAR.silver)
        )) == WANTED


def test_replay_alone_finds_what_silver_lacks(spark, place, late_jobs):
    tables = late_jobs[1]()
    for _ in range(3):
        assert held(replay(
            spark.table(place.table("fact_bronze")), place.room(), dims_of(STAR.hops, tables), with_identity(STAR.silver)
        )) == WANTED
        assert place.room().waiting_rows(spark).count() == 0


def test_only_waiting_rows_are_read(spark, place, late_jobs, tmp_path):
    early, land = late_jobs
    room = place.room()

    def files() -> set[str]:
        return {f.split("/fact_waiting/")[1].rsplit("/", 1)[0] for f in room.waiting_rows(spark).inputFiles()}

    assert files() == {"run=0/part=0"} and room.waiting_rows(spark).select("missing").distinct().collect()[0][0] == [0]
    again(spark, place, early)
    assert files() == {"run=1/part=-1"}
    drop(tmp_path / "in", "b.json", person(9, job_id=2))
    take_in(spark, STAR, place, str(tmp_path / "in"), early)
    assert files() == {"run=1/part=-1", "run=0/part=1"}
    assert held(again(spark, place, land())) == WANTED + Counter({(9, 2): 1})
    assert files() == set()


def test_a_run_that_failed_before_its_note_counts_for_nothing(spark, place, late_jobs, monkeypatch):
    tables = late_jobs[1]()

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(medallion, "append_log", fail)
        with pytest.raises(RuntimeError):
            again(spark, place, tables)
    assert held(facts(spark, place)) == Counter({(5, 1): 1, (None, 1): 1})
    assert held(again(spark, place, tables)) == WANTED
    assert held(again(spark, place, tables)) == WANTED


def test_a_batch_that_is_repeated_replaces_itself(spark, place, tmp_path):
    drop(tmp_path / "in", "a.json", person(1), person(2))
    table = place.table("fact_bronze")
    bronze(spark, str(tmp_path / "in"), staff.EMPLOYEES.schema, table, place.checkpoint("bronze"))
    spark.table(table).write.parquet(f"{tmp_path}/copy")
    rows = spark.read.parquet(f"{tmp_path}/copy")
    overwrite_partition(spark, rows.drop("batch_id"), table, {"batch_id": 0})
    assert spark.table(table).count() == 2
    assert spark.table(table).select("batch_id", "row_id").distinct().count() == 2


def test_what_a_column_cannot_hold_is_rescued(spark, place, tmp_path):
    drop(tmp_path / "in", "a.json",
         person(1, salary=2500.129), person(2, hire_date="1999-01-31T10:20:30"), person(3, hire_date="1999-01-31T00:00:00"),
         person(4, extra={"a": [1, None]}, nothing=None))
    table = place.table("fact_bronze")
    bronze(spark, str(tmp_path / "in"), staff.EMPLOYEES.schema, table, place.checkpoint("bronze"))
    rows = {r.employee_id: r for r in spark.table(table).select("*", F.col("document").cast("string").alias("d")).collect()}
    assert rows[1].salary is None and json.loads(rows[1].rescued) == {"salary": 2500.129}
    assert rows[2].hire_date is None and json.loads(rows[2].rescued) == {"hire_date": "1999-01-31T10:20:30"}
    assert rows[3].hire_date.day == 31 and rows[3].rescued is None
    assert json.loads(rows[4].rescued) == {"extra": {"a": [1, None]}, "nothing": None}
    assert json.loads(rows[1].d) == person(1, salary=2500.129)
    assert {f for r in rows.values() for f in json.loads(r.d)} == {*person(1), "extra", "nothing"}


def test_documents_that_name_a_field_twice_or_are_none(spark, place, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.json").write_text('{"n": 1, "n": 2, "x": 3}\n\n[1]\n"text"\n{"n": 4, "n ot": null}\n')
    table, schema = place.table("raw"), T.StructType().add("n", "integer")
    bronze(spark, str(folder), schema, table, place.checkpoint("raw"), multi_line=False)
    rows = spark.table(table).select("n", "rescued", F.col("document").cast("string").alias("d")).collect()
    assert sorted((r.n or 0, r.rescued or "", r.d or "") for r in rows) == [
        (0, '"text"', ""), (0, "[1]", ""), (1, '{"n":1,"n":2,"x":3}', '{"n":1,"x":3}'), (4, '{"n ot":null}', '{"n":4,"n ot":null}'),
    ]


def test_a_new_field_becomes_a_column(spark, place, tmp_path):
    folder, table, log = tmp_path / "in", place.table("fact_bronze"), place.checkpoint("versions")
    schema = staff.EMPLOYEES.schema

    def run():
        bronze(spark, str(folder), schema, table, place.checkpoint("bronze"), versions=log)
        return evolve(spark, table, log, schema)

    drop(folder, "a.json", person(1), person(2, badge=7, tags=["x"], Email="other case", blank=None))
    drop(folder, "b.json", person(3, badge="B7"))
    newest = run()
    # Numbers and texts in one field become text; the field that is always null waits.
    assert [(f.name, f.dataType.simpleString()) for f in newest.fields[len(schema):]] == [("badge", "string"), ("tags", "array<string>")]
    assert "badge" not in spark.table(table).columns
    drop(folder, "c.json", person(4, badge=8, blank=1.5))
    assert [f.name for f in run().fields[-2:]] == ["tags", "blank"]
    rows = {r.employee_id: r for r in spark.table(table).collect()}
    assert (rows[2].badge, rows[4].badge, rows[2].schema_version, rows[4].schema_version) == (None, "8", 1, 2)
    assert json.loads(rows[2].rescued)["badge"] == 7 and json.loads(rows[4].rescued) == {"blank": 1.5}
    later = {r.employee_id: r for r in as_version(spark.table(table), current_version(spark, log, schema).schema).collect()}
    assert [later[k].badge for k in (1, 2, 3, 4)] == [None, "7", "B7", "8"]
    assert later[2].tags == ["x"] and float(later[4].blank) == 1.5
    run()
    assert [v.number for v in versions(spark, log)] == [1, 2, 3]


def test_variant_schemas_are_read(spark):
    text = spark.sql("""SELECT schema_of_variant(parse_json('{"a b": 1, "c": [1, "x"], "d": null, "e": {"OBJECT<f": 1.5, "g": null}}'))""").first()[0]
    assert variant_schema(text).simpleString() == (
        "struct<a b:bigint,c:array<string>,d:void,e:struct<OBJECT<f:decimal(38,10),g:string>>"
    )
    assert variant_schema("BIGINT") == T.StructType()


EXACT = [
    ("2500.129", money(), False), ("2500.1200", money(), True), ("1.23E1", money(), True), ("1.2345E1", money(), False),
    ("9999999", money(), False), ("lots", money(), False), ("1999-01-31T10:20:30", DATE, False), ("1999-01-31", DATE, True),
    ("1999-01-31Tx", DATE, False), ("2020-01-01T00:00:00.1234567", T.TimestampType(), False),
    ("2020-01-01T00:00:00Z", T.TimestampNTZType(), False), ("2020-01-01 00:00:00", T.TimestampNTZType(), True),
    ("16777217", T.FloatType(), False), ("0.1", T.DoubleType(), True), ("0.1234567890123456789", T.DoubleType(), False),
    ("12.0", T.IntegerType(), False), ("3000000000", T.IntegerType(), False), ("oops", T.StructType().add("a", "long"), False),
    ('{"a": 1}', T.StructType().add("a", "long"), True), ("anything", TEXT, True),
]


@pytest.mark.parametrize("text,kind,wanted", EXACT)
def test_exact_casts(spark, text, kind, wanted):
    assert spark.createDataFrame([(text,)], "t string").select(exact(F.col("t"), kind)).first()[0] is wanted


def test_types_are_audited_by_the_way_back(spark):
    table = Table("t", ("k", "l"), (Field("k", TEXT), Field("pay", money()), Field("day", DATE)))
    frame = spark.sql("""
        SELECT 'a' AS k, CAST(NULL AS string) AS l, 2500.129 AS pay, TIMESTAMP_NTZ'1999-01-31 10:20:30' AS day
        UNION ALL SELECT NULL, 'a', 2500.12, TIMESTAMP_NTZ'1999-01-31 00:00:00'
    """)
    found = sorted((r.rule, r.key) for r in audit_types(frame, table).collect())
    assert found == [("type:day", '{"k":"a","l":null}'), ("type:pay", '{"k":"a","l":null}')]
    assert frame.select(changed_by_cast(frame, "k", TEXT)).distinct().count() == 1


def test_a_run_leaves_no_shuffle_files_and_keeps_no_rows(spark, place, late_jobs, conf):
    """What the joins of one step have shuffled must be gone before the next one fills the disks."""
    import time
    from pathlib import Path

    disks = [Path(d) for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()]

    def shuffled() -> set[str]:
        return {p.name for d in disks for p in d.rglob("shuffle_*.data")}

    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    tables, room = late_jobs[1](), place.room()
    # A table of one small file is joined without a shuffle.
    rows = spark.table(place.table("fact_bronze")).repartition(3)
    before, kept = shuffled(), spark.sparkContext._jsc.getPersistentRDDs().size()
    everything = replay(rows, room, dims_of(STAR.hops, tables), with_identity(STAR.silver))
    until = time.monotonic() + 5
    while shuffled() - before and time.monotonic() < until:
        time.sleep(0.2)
    assert not shuffled() - before
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == kept
    assert held(everything) == WANTED


def test_stored_rows_are_there_for_one_block(spark, place, tmp_path):
    from pathlib import Path

    from orrery.session import shared_root, stored

    def files() -> set[str]:
        return {p.name for p in Path(shared_root(spark)).iterdir() if "-halves-" in p.name}

    option = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    known = spark.conf.get(option, None)
    with pytest.raises(RuntimeError), stored(spark.range(4).selectExpr("id / 2 AS half"), "halves") as rows:
        assert sorted(r.half for r in rows.collect()) == [0.0, 0.5, 1.0, 1.5]
        assert len(files()) == 1 and spark.conf.get(option, None) == known
        raise RuntimeError("lost")
    assert files() == set()


@pytest.mark.parametrize("text, expected", [
    ('{"a": 1, "b": 2}', None), ('{"b": 2, "a": 1}', None), ('{"a": 1}', None), ("{}", None),
    ('{"a": 1, "c": 3}', {"c": 3}), ('{"A": 1}', {"A": 1}), ('{"b": 2, "c": null}', {"c": None}),
])
def test_fields_left_over_do_not_depend_on_order(spark, text, expected):
    from orrery.sources.documents import left_over

    fields = F.from_json(F.lit(text), "map<string,variant>")
    for misfits in ([], ["b"]):
        listed = F.array(*[F.lit(m) for m in misfits]).cast("array<string>")
        got = spark.range(1).select(left_over(fields, ["a", "b"], listed)).first()[0]
        told = {k: v for k, v in json.loads(text).items() if k in misfits}
        assert (got and json.loads(got)) == ({**(expected or {}), **told} or None)
