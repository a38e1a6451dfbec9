"""Dimensions landed under audit."""

from __future__ import annotations

import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orrery.models import staff
from orrery.plans.landing import LandingRefused, land_audited
from orrery.plans.warehouse import refresh
from orrery.session import remove
from tests import staff_rows
from tests.test_streams import drop, person

STAR = staff.STAR


@pytest.fixture
def hr(spark):
    return staff_rows.tables(spark)


def listed(spark, place, load):
    rows = place.landing().violations(spark).where(F.col("load") == load).collect()
    return sorted((r.table_name, r.rule, r.key, r.value or "") for r in rows)


def test_sound_sources_land_as_they_are(spark, place, hr):
    tables = land_audited(spark, STAR, place.landing({"required": 0, "key": 0, "type": 0, "length": 0, "reference": 0}), hr)
    assert tables["dim_jobs"].columns == ["job_key", "job_title", "min_salary", "max_salary"]
    assert tables["dim_employees"].count() == hr["employees"].count() and listed(spark, place, 1) == []


def test_all_kinds_of_violations_are_listed(spark, place, hr):
    jobs = spark.createDataFrame(
        [("1", "Clerk", "2000.129", "5000"), ("1", None, "x", "5000"), (None, "T" * 36, None, "1")],
        "job_id string, job_title string, min_salary string, max_salary string",
    )
    land_audited(spark, STAR, place.landing(), {**hr, "jobs": jobs})
    found = listed(spark, place, 1)
    assert [f for f in found if f[0] == "dim_jobs"] == [
        ("dim_jobs", "key:job_key", "1", "2"), ("dim_jobs", "length:job_title", None, "36"),
        ("dim_jobs", "required:job_id", None, ""), ("dim_jobs", "required:job_title", "1", ""),
        ("dim_jobs", "type:min_salary", "1", "2000.129"), ("dim_jobs", "type:min_salary", "1", "x"),
    ]
    # Employees refer to jobs that are gone.
    assert {f[1] for f in found if f[0] == "dim_employees"} == {"reference:job_key"}


def test_a_refused_load_changes_nothing(spark, place, hr, tmp_path):
    drop(tmp_path / "in", "a.json", person(1))
    report = refresh(spark, STAR, place, hr, str(tmp_path / "in")).collect()
    drop(tmp_path / "in", "b.json", person(2))
    twice = {**hr, "jobs": hr["jobs"].unionByName(hr["jobs"].withColumn("min_salary", F.lit(Decimal("1.00"))))}
    with pytest.raises(LandingRefused) as refused:
        refresh(spark, STAR, place, twice, str(tmp_path / "in"), {"key:job_key": 0})
    n = hr["jobs"].count()
    assert refused.value.counts == {("dim_jobs", "key:job_key"): n} and len(listed(spark, place, 2)) == n
    assert spark.table(place.table("dim_jobs")).count() == n and place.fact().rows(spark).count() == 1
    assert os.listdir(f"{place.root}/dimensions/dim_jobs".removeprefix("file:"))[0].startswith("1-")
    assert refresh(spark, STAR, place, hr, str(tmp_path / "in"), {"key:job_key": 0}).columns == list(report[0].asDict())
    assert place.fact().rows(spark).count() == 2


def test_old_folders_go_but_the_last_two(spark, place, hr):
    before = None
    for n in range(1, 5):
        jobs = hr["jobs"].withColumn("min_salary", F.lit(n).cast("decimal(8,2)"))
        tables = land_audited(spark, STAR, place.landing(), {**hr, "jobs": jobs})
        assert tables["dim_jobs"].select("min_salary").distinct().collect() == [(Decimal(n),)]
        if before is not None:
            # What was read from the load before can still be read.
            assert before.select("min_salary").distinct().collect() == [(Decimal(n - 1),)]
        before = spark.table(place.table("dim_jobs"))
    kept = sorted(d.split("-")[0] for d in os.listdir(f"{place.root}/dimensions/dim_jobs"))
    assert kept == ["3", "4"]


def test_only_folders_below_the_root_are_removed(spark, tmp_path):
    (tmp_path / "a" / "b").mkdir(parents=True)
    for path in (str(tmp_path), f"{tmp_path}/a/../c", f"{tmp_path}/a"):
        with pytest.raises(ValueError):
            remove(spark, path, below=f"{tmp_path}/a")
    assert remove(spark, f"{tmp_path}/a/b", below=f"{tmp_path}/a") and not remove(spark, f"{tmp_path}/a/b", below=f"{tmp_path}/a")
