from __future__ import annotations

import pytest

from orrery.operators.find import find


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame(
        [(1, "a", 10.0), (2, "b", None), (3, None, 30.0), (4, "a", 40.0)],
        "id int, team string, score double",
    ).cache()


def ids(df):
    return [r.id for r in df.collect()]


@pytest.mark.parametrize(
    ("conditions", "wanted"),
    [
        (None, [1, 2, 3, 4]),
        ({}, [1, 2, 3, 4]),
        ({"team": "a"}, [1, 4]),
        ({"team": None}, [3]),
        ({"team": {"$eq": "b"}}, [2]),
        ({"team": {"$ne": "a"}}, [2, 3]),
        ({"team": {"$ne": None}}, [1, 2, 4]),
        ({"score": {"$gt": 10}}, [3, 4]),
        ({"score": {"$gte": 10, "$lt": 40}}, [1, 3]),
        ({"score": {"$lte": 10}}, [1]),
        ({"team": {"$in": ["a", None]}}, [1, 3, 4]),
        ({"team": {"$in": []}}, []),
        ({"team": {"$nin": ["a"]}}, [2, 3]),
        ({"team": {"$nin": ["a", None]}}, [2]),
        ({"team": {"$nin": []}}, [1, 2, 3, 4]),
        ({"score": {"$exists": False}}, [2]),
        ({"absent": {"$exists": False}}, [1, 2, 3, 4]),
        ({"absent": None}, [1, 2, 3, 4]),
        ({"absent": "x"}, []),
        ({"absent": {"$ne": "x"}}, [1, 2, 3, 4]),
        ({"$or": [{"team": "b"}, {"score": {"$gt": 30}}]}, [2, 4]),
        ({"$and": [{"team": "a"}, {"score": {"$gt": 10}}], "id": 4}, [4]),
    ],
)
def test_conditions(people, conditions, wanted):
    assert sorted(ids(find(people, conditions))) == wanted


def test_each_argument_is_honoured_alone(people):
    assert find(people, projection=["id"]).columns == ["id"]
    assert ids(find(people, sort=[("score", 1)])) == [2, 1, 3, 4]
    assert ids(find(people, sort=[("score", -1)])) == [4, 3, 1, 2]
    assert ids(find(people, sort=[("team", 1), ("id", -1)])) == [3, 4, 1, 2]


def test_projection_includes_or_excludes(people):
    assert find(people, projection={"score": 0}).columns == ["id", "team"]
    assert find(people, projection={"team": 1, "absent": 1}).columns == ["team", "absent"]
    with pytest.raises(ValueError):
        find(people, projection={"team": 1, "id": 0})


def test_sort_by_a_field_left_out_of_the_projection(people):
    rows = find(people, {"score": {"$exists": True}}, ["id"], [("score", -1)])
    assert ids(rows) == [4, 3, 1]


def test_unknown_operators_are_refused(people):
    with pytest.raises(ValueError):
        find(people, {"team": {"$near": 1}})
    with pytest.raises(ValueError):
        find(people, {"$xor": []})


def test_conditions_reach_the_file_reader(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    plan = find(events, {"value": {"$gt": 5}, "event_type": {"$in": ["click"]}}, ["event_id"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(value,5.0)" in text and "EqualTo(event_type,click)" in text
    assert "ReadSchema: struct<event_id:bigint,event_type:string,value:double>" in text


def test_nested_fields_present_or_absent(spark):
    rows = spark.sql("SELECT 1 AS id, named_struct('x', 5, 'y', 6) AS at UNION ALL SELECT 2, named_struct('x', 3, 'y', 4)")
    assert sorted(ids(find(rows, {"at.z": None}))) == [1, 2]
    assert ids(find(rows, {"at.z": 1})) == []
    assert ids(find(rows, sort=[("at.z", 1), ("at.x", 1)])) == [2, 1]
    assert find(rows, projection={"at.x": 0}).schema["at"].dataType.names == ["y"]
    assert find(rows, projection={"at.z": 0}).schema == rows.schema
    assert find(rows, projection=["id", "at.z"]).filter("id = 1").first()[1] is None
