"""Rebuilds leave one generation, and scratch goes with its owner."""

from __future__ import annotations

import os

import pytest

from orrery.models import staff
from orrery.operators.keys import number_rows
from orrery.plans import warehouse
from orrery.plans.landing import LandingRefused
from orrery.plans.warehouse import live, rebuild, refresh
from orrery.session import owned_scratch, release_scratch, scratch, shared_root
from tests import staff_rows
from tests.test_streams import drop, person

STAR = staff.STAR


@pytest.fixture
def hr(spark):
    return staff_rows.tables(spark)


def generations(place) -> list[str]:
    return [d for d in os.listdir(place.base().root) if d.startswith("generation_")]


def databases(spark, place) -> list[str]:
    return [r[0] for r in spark.sql(f"SHOW DATABASES LIKE '{place.base().database}*'").collect()]


def test_rebuilds_leave_one_root(spark, place, hr, tmp_path):
    drop(tmp_path / "in", "a.json", person(1))
    first = place
    for _ in range(4):
        place, report = rebuild(spark, STAR, place, hr, str(tmp_path / "in"))
        assert report.count() == 1 and live(spark, first) == place
    assert len(generations(place)) == 1 and databases(spark, place) == [place.database]
    assert sorted(os.listdir(first.root)) == sorted(["live", *generations(place)])
    drop(tmp_path / "in", "b.json", person(2))
    refresh(spark, STAR, live(spark, first), hr, str(tmp_path / "in"))
    assert place.fact().rows(spark).count() == 2


def test_a_failed_rebuild_leaves_the_old_one_alive(spark, place, hr, tmp_path, monkeypatch):
    drop(tmp_path / "in", "a.json", person(1))
    place, _ = rebuild(spark, STAR, place, hr, str(tmp_path / "in"))
    twice = {**hr, "jobs": hr["jobs"].unionByName(hr["jobs"])}
    with pytest.raises(LandingRefused):
        rebuild(spark, STAR, place, twice, str(tmp_path / "in"), {"key": 0})

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(warehouse, "land_dates", fail)
        with pytest.raises(RuntimeError):
            rebuild(spark, STAR, place, hr, str(tmp_path / "in"))
    assert live(spark, place) == place and len(generations(place)) == 1 and databases(spark, place) == [place.database]
    assert place.fact().rows(spark).count() == 1


def test_of_two_results_one_is_released(spark):
    results = []
    for _ in range(2):
        with owned_scratch() as owner:
            folder = scratch(spark, "test")
            spark.range(3).write.parquet(folder)
            results.append((owner, number_rows(spark.range(10, 20), "n"), folder))
    unowned = number_rows(spark.range(5), "n")
    release_scratch(spark, results[0][0])
    assert not os.path.exists(f"{shared_root(spark)}/orrery-owned-{results[0][0]}")
    assert results[1][1].count() == 10 and spark.read.parquet(results[1][2]).count() == 3 and unowned.count() == 5
    with pytest.raises(Exception):
        spark.read.parquet(results[0][2]).count()
