"""The human-resources lakehouse from files, with the database scan replaced by its rows."""

from __future__ import annotations

import json

import pytest

from orrery.plans import staffing
from orrery.plans.warehouse import facts
from tests import staff_rows


@pytest.fixture
def sources(spark, tmp_path, monkeypatch):
    hr = staff_rows.tables(spark)
    for name in ("departments", "employees"):
        documents = [json.loads(line) for line in hr[name].toJSON().collect()]
        (tmp_path / f"{name}.json").write_text(json.dumps(documents, indent=2))
    (tmp_path / "locations.csv").write_text(
        "location_id,street_address,postal_code,city,state_province,country_id\n"
        '10,"1 Hill Road",X1Y 2Z3,Ashby,NULL,AA\n20,"Unit 2, Low Street",00123,Borley,Kent,BB\n'
    )
    monkeypatch.setattr(staffing, "scan_query", lambda *_: hr["jobs"])
    return staffing.Sources(
        "jdbc:mysql://db.example.org:3306/hr", {}, str(tmp_path / "departments.json"),
        str(tmp_path / "locations.csv"), str(tmp_path / "employees.json"),
    )


def test_the_whole_job(spark, place, sources, tmp_path):
    feed = tmp_path / "feed"
    feed.mkdir()
    (feed / "1.json").write_text((tmp_path / "employees.json").read_text())
    place, report = staffing.build(spark, place, sources, str(feed))
    rows = report.collect()
    assert [r.job_title for r in rows] == ["Director", "Clerk"]
    assert rows[1].avg_min_salary == pytest.approx(2200.0)
    locations = spark.table(place.table("dim_locations"))
    assert locations.filter("location_key = 20").first().postal_code == "00123"
    assert spark.table(place.table("dim_employees")).filter("manager_key = 100").count() == 3
    more = {"employee_id": 106, "last_name": "Six", "email": "s@example.org",
            "hire_date": "2003-01-01", "job_id": 2, "salary": 4400, "department_id": 1}
    (feed / "2.json").write_text(json.dumps([more]))
    # employee 104's department gets its location only now
    departments = json.loads((tmp_path / "departments.json").read_text())
    for row in departments:
        row["location_id"] = row.get("location_id", 10)
    (tmp_path / "departments.json").write_text(json.dumps(departments))
    rows = staffing.update(spark, place, sources, str(feed)).collect()
    assert [r.job_title for r in rows] == ["Director", "Clerk", "Planner"]
    assert spark.table(place.table("fact_silver")).count() == 5
    late = spark.table(place.table("fact_silver_late")).collect()
    assert [(r.employee_key, r.location_key) for r in late] == [(104, 10)]
    staffing.update(spark, place, sources, str(feed))
    assert facts(spark, place).count() == 6
    assert spark.table(place.table("dim_date")).agg({"full_date": "max"}).first()[0].year == 2003
