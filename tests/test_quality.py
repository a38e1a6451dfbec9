from __future__ import annotations

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from orrery.models import staff
from orrery.models.table import Reference
from orrery.operators import audits
from orrery.operators.cascade import KEY_MAP, cascade_delete, cascade_update, key_conflicts
from orrery.operators.closure import delete_closure
from tests import staff_rows

MANAGER = staff.REFERENCES[5]


@pytest.fixture(scope="module")
def hr(spark):
    return {name: df.cache() for name, df in staff_rows.tables(spark).items()}


def found(df):
    return sorted((r.rule, r.key, r.value) for r in df.collect())


def ids(df, column):
    return sorted(r[column] for r in df.collect())


def test_sound_rows_break_no_rule(hr):
    for name, table in staff.TABLES.items():
        assert found(audits.audit(hr[name], table)) == []
        assert audits.pk_duplicates(hr[name], list(table.key)).collect() == []
    for r in staff.REFERENCES:
        orphans = audits.fk_orphans(
            hr[r.child], list(r.child_key), hr[r.parent], list(r.parent_key)
        )
        assert orphans.collect() == []


def test_one_scan_lists_every_broken_rule_of_a_row(spark):
    rows = spark.createDataFrame(
        [("ABC", "x" * 41, None), ("AA", "fine", 1)], staff.COUNTRIES.schema
    )
    assert found(audits.audit(rows, staff.COUNTRIES)) == [
        ("length:country_id", "ABC", "3"),
        ("length:country_name", "ABC", "41"),
        ("required:region_id", "ABC", None),
    ]
    plan = audits.audit(rows, staff.COUNTRIES)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_values_of_the_wrong_type(spark):
    raw = spark.createDataFrame(
        [("1", "Clerk", "2000.00", "5000.00"), ("2", "Planner", "n/a", "1234567.00"),
         ("x", None, None, "1e3")],
        "job_id string, job_title string, min_salary string, max_salary string",
    )
    assert found(audits.audit_types(raw, staff.JOBS)) == [
        ("type:job_id", "x", "x"),
        ("type:max_salary", "2", "1234567.00"),
        ("type:min_salary", "2", "n/a"),
    ]


def test_duplicate_keys(spark):
    rows = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (2, 1), (1, 1)], "a int, b int")
    assert [tuple(r) for r in audits.pk_duplicates(rows, ["a", "b"]).collect()] == [(1, 1, 3)]


def test_orphans_are_counted_and_null_references_pass(spark, hr):
    moved = hr["employees"].withColumn(
        "department_id", F.when(F.col("job_id") == 1, 77).otherwise(F.col("department_id"))
    )
    orphans = audits.fk_orphans(moved, ["department_id"], hr["departments"], ["department_id"])
    assert [tuple(r) for r in orphans.collect()] == [(77, 2)]


def test_a_reference_of_a_table_to_itself(hr):
    without_boss = hr["employees"].filter("employee_id <> 100")
    orphans = audits.fk_orphans(without_boss, ["manager_id"], without_boss, ["employee_id"])
    assert [tuple(r) for r in orphans.collect()] == [(100, 3)]


def test_delete_follows_every_path_and_leaves_no_orphan(hr):
    left, blocked = cascade_delete(hr, staff.REFERENCES, "regions", "region_id = 2")
    assert ids(left["countries"], "country_id") == ["AA"]
    assert ids(left["locations"], "location_id") == [10]
    assert ids(left["departments"], "department_id") == [1, 3]
    assert ids(left["employees"], "employee_id") == [101, 102, 104, 105]
    assert ids(left["dependents"], "dependent_id") == [2]
    assert "jobs" not in left
    for r in staff.REFERENCES:
        if r.cascade and r.parent in left and r.child in left:
            orphans = audits.fk_orphans(
                left[r.child], list(r.child_key), left[r.parent], list(r.parent_key)
            )
            assert orphans.collect() == []
    assert ids(blocked[MANAGER], "employee_id") == [101, 104, 105]


def test_delete_through_two_parents(hr):
    left, blocked = cascade_delete(hr, staff.REFERENCES, "jobs", "job_title = 'Clerk'")
    assert ids(left["employees"], "employee_id") == [100, 104, 105]
    assert ids(left["dependents"], "dependent_id") == [1]
    assert blocked[MANAGER].collect() == []


def test_a_null_condition_deletes_nothing(hr):
    left, _ = cascade_delete(hr, staff.REFERENCES, "jobs", "min_salary > 3500")
    assert ids(left["jobs"], "job_id") == [1, 3, 4]


def test_a_delete_cycle_is_refused(hr):
    looped = (replace(MANAGER, cascade=True),)
    with pytest.raises(ValueError, match="itself"):
        cascade_delete(hr, looped, "employees", "true")
    ring = (Reference("a", ("x",), "b", ("x",)), Reference("b", ("x",), "a", ("x",)))
    with pytest.raises(ValueError, match="cycle"):
        cascade_delete({"a": hr["jobs"], "b": hr["jobs"], "c": hr["jobs"]},
                       (Reference("a", ("x",), "c", ("x",)), *ring), "c", "true")


def test_new_keys_reach_the_children(spark, hr):
    keys = spark.createDataFrame([(1, 11), (2, 12)], "old int, new int")
    changed, blocked = cascade_update(hr, staff.REFERENCES, "departments", "department_id", keys)
    assert ids(changed["departments"], "department_id") == [3, 11, 12]
    assert {r.employee_id: r.department_id for r in changed["employees"].collect()} == {
        100: 12, 101: 11, 102: 11, 103: 12, 104: 3, 105: None
    }
    assert set(changed) == {"departments", "employees"} and not blocked


def test_a_key_that_is_held_blocks_its_change(spark, hr):
    keys = spark.createDataFrame([(100, 900), (105, 905)], "old int, new int")
    changed, blocked = cascade_update(hr, staff.REFERENCES, "employees", "employee_id", keys)
    assert ids(changed["dependents"], "employee_id") == [101, 900]
    assert ids(blocked[MANAGER], "employee_id") == [101, 104, 105]


def test_a_reference_of_two_columns(spark):
    turns = spark.createDataFrame([(1, 1), (1, 2), (2, 1)], "conv int, turn int")
    notes = spark.createDataFrame(
        [(10, 1, 1), (11, 1, None), (12, 2, 1), (13, None, 1)], "id int, conv int, turn int"
    )
    reference = Reference("notes", ("conv", "turn"), "turns", ("conv", "turn"))
    tables = {"turns": turns, "notes": notes}
    left, _ = cascade_delete(tables, (reference,), "turns", "conv = 1")
    assert ids(left["notes"], "id") == [11, 12, 13]
    keys = spark.createDataFrame([(1, 5), (2, 1)], "old int, new int")
    changed, _ = cascade_update(tables, (reference,), "turns", "conv", keys)
    assert ids(changed["turns"], "conv") == [1, 5, 5]
    assert {r.id: r.conv for r in changed["notes"].collect()} == {10: 5, 11: 1, 12: 1, 13: None}


def test_unfit_key_maps_are_reported(spark):
    rows = spark.createDataFrame([(1,), (2,), (3,), (4,), (None,)], "id int")

    def conflicts(*pairs):
        found = key_conflicts(rows, "id", spark.createDataFrame(pairs, "old int, new int"))
        return sorted(tuple(r) for r in found.collect())

    assert conflicts((1, 2), (1, 3)) == [(1, "repeated"), (2, "taken"), (3, "taken")]
    assert conflicts((1, 9), (2, 9)) == [(9, "taken")]
    assert conflicts((1, 2), (2, 1), (3, 3), (4, 8)) == []


def test_a_ring_through_the_root_is_refused(hr):
    ring = (Reference("a", ("x",), "b", ("x",)), Reference("b", ("x",), "a", ("x",)))
    with pytest.raises(ValueError, match="ring"):
        cascade_delete({"a": hr["jobs"], "b": hr["jobs"]}, ring, "a", "true")


@pytest.mark.parametrize("root,condition", [
    ("regions", "region_id = 2"), ("jobs", "job_title = 'Clerk'"), ("jobs", "min_salary > 3500"), ("employees", "employee_id = 100"),
])
def test_the_closure_equals_the_plan_without_rounds(hr, root, condition):
    plain, blocked = cascade_delete(hr, staff.REFERENCES, root, condition)
    left, held = delete_closure(hr, staff.REFERENCES, root, condition)
    assert plain.keys() == left.keys() and {r for r in held if not held[r].isEmpty()} == {r for r in blocked if not blocked[r].isEmpty()}
    for name in plain:
        assert sorted(map(str, left[name].collect())) == sorted(map(str, plain[name].collect()))
    for r in blocked:
        assert sorted(map(str, held[r].collect())) == sorted(map(str, blocked[r].collect()))


def plain_closure(rows: list[tuple], start: set) -> list[tuple]:
    gone, more = set(start), True
    while more:
        more = {k for k, boss in rows if boss in gone} - gone
        gone |= more
    return sorted((r for r in rows if r[0] not in gone), key=str)


def test_a_chain_of_managers_goes_with_the_first(spark):
    rows = [(k, k - 1 if k % 10 else None) for k in range(40)] + [(100, 100), (101, 102), (102, 101), (103, 100), (104, None)]
    people = spark.createDataFrame(rows, "employee_id int, manager_id int")
    own = (Reference("people", ("manager_id",), "people", ("employee_id",)),)
    for condition, start in (("employee_id IN (3, 25)", {3, 25}), ("employee_id = 101", {101}), ("employee_id = 100", {100}), ("false", set())):
        left, _ = delete_closure({"people": people}, own, "people", condition)
        assert sorted((tuple(r) for r in left["people"].collect()), key=str) == plain_closure(rows, start)


def test_a_ring_of_tables(spark):
    a = spark.createDataFrame([(1, 9), (2, 11), (3, None), (4, 12)], "x int, b int")
    b = spark.createDataFrame([(11, 1), (12, 2), (13, 3), (9, 7)], "y int, a int")
    ring = (Reference("a", ("b",), "b", ("y",)), Reference("b", ("a",), "a", ("x",)))
    left, _ = delete_closure({"a": a, "b": b}, ring, "a", "x = 1")
    # 1 takes 11, 11 takes 2, 2 takes 12, 12 takes 4.
    assert ids(left["a"], "x") == [3] and ids(left["b"], "y") == [9, 13]


def test_tables_are_read_at_most_twice(spark, tmp_path):
    rows = spark.range(1000).select("id", (F.col("id") - 1).alias("boss"))
    rows.write.parquet(str(tmp_path / "people"))
    reads = []

    class Watched(dict):
        def __getitem__(self, name):
            reads.append(name)
            return super().__getitem__(name)

    people = Watched(people=spark.read.parquet(str(tmp_path / "people")))
    own = (Reference("people", ("boss",), "people", ("id",)),)
    left, _ = delete_closure(people, own, "people", "id = 990")
    assert left["people"].count() == 990
    # The session, the key columns, the first rows, the survivors: none of them within a round.
    assert len(reads) == 4


def test_a_bad_key_map_changes_nothing(spark, hr):
    keys = spark.createDataFrame([(1, 2), (1, 3)], "old int, new int")
    changed, blocked = cascade_update(hr, staff.REFERENCES, "departments", "department_id", keys)
    assert set(changed) == {"departments", "employees"} and set(blocked) == {KEY_MAP}
    assert ids(changed["departments"], "department_id") == [1, 2, 3]
    assert {r.conflict for r in blocked[KEY_MAP].collect()} == {"repeated", "taken"}
    none = spark.createDataFrame([(1, None)], "old int, new int")
    assert cascade_update(hr, staff.REFERENCES, "departments", "department_id", none)[1][KEY_MAP].collect() == [(1, "null")]


def test_keys_are_swapped(spark, hr):
    keys = spark.createDataFrame([(1, 2), (2, 1), (2, 1)], "old int, new int")
    changed, blocked = cascade_update(hr, staff.REFERENCES, "departments", "department_id", keys)
    assert ids(changed["departments"], "department_id") == [1, 2, 3] and not blocked
    assert {r.employee_id: r.department_id for r in changed["employees"].collect()} == {100: 1, 101: 2, 102: 2, 103: 1, 104: 3, 105: None}


def test_keys_with_nulls_do_not_look_alike(spark):
    rows = spark.createDataFrame([("a", None), (None, "a")], "k string, l string")
    assert {r.key for r in audits.audit_required(rows, ("k", "l"), ["k", "l"]).collect()} == {'{"k":"a","l":null}', '{"k":null,"l":"a"}'}


def test_the_model_audit_looks_for_every_parent(spark, tmp_path):
    from __spark_entry__ import queries

    rows = {
        "region": ["2 AS r_regionkey"],
        "nation": ["13 AS n_nationkey", "2 AS n_regionkey"],
        "customer": ["2L AS c_custkey", "13 AS c_nationkey"],
        "supplier": ["24L AS s_suppkey", "13 AS s_nationkey"],
        "part": ["35L AS p_partkey"],
        "orders": ["46L AS o_orderkey", "2L AS o_custkey"],
        "lineitem": ["46L AS l_orderkey", "35L AS l_partkey", "explode(array(24L, 25L)) AS l_suppkey"],
    }
    for name, columns in rows.items():
        spark.range(1).selectExpr(*columns).write.parquet(str(tmp_path / f"{name}.parquet"))
    found = {r.reference: r.orphans for r in queries()["fk_audit_model"](spark, str(tmp_path)).collect()}
    assert found.pop("lineitem.l_suppkey") == 1 and len(found) == 6 and not any(found.values())
