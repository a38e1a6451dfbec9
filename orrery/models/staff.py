"""The human-resources model: operational tables, their references, and the star."""

from __future__ import annotations

from orrery.models.table import (
    DATE, INT, TEXT, Band, Dimension, Field, Hop, Reference, Star, Table, money,
)

# Column names, types, limits and references of the operational schema.
REGIONS = Table("regions", ("region_id",), (
    Field("region_id", INT, required=True),
    Field("region_name", TEXT, length=25),
))
COUNTRIES = Table("countries", ("country_id",), (
    Field("country_id", TEXT, required=True, length=2),
    Field("country_name", TEXT, length=40),
    Field("region_id", INT, required=True),
))
LOCATIONS = Table("locations", ("location_id",), (
    Field("location_id", INT, required=True),
    Field("street_address", TEXT, length=40),
    Field("postal_code", TEXT, length=12),
    Field("city", TEXT, required=True, length=30),
    Field("state_province", TEXT, length=25),
    Field("country_id", TEXT, required=True, length=2),
))
JOBS = Table("jobs", ("job_id",), (
    Field("job_id", INT, required=True),
    Field("job_title", TEXT, required=True, length=35),
    Field("min_salary", money()),
    Field("max_salary", money()),
))
DEPARTMENTS = Table("departments", ("department_id",), (
    Field("department_id", INT, required=True),
    Field("department_name", TEXT, required=True, length=30),
    Field("location_id", INT),
))
EMPLOYEES = Table("employees", ("employee_id",), (
    Field("employee_id", INT, required=True),
    Field("first_name", TEXT, length=20),
    Field("last_name", TEXT, required=True, length=25),
    Field("email", TEXT, required=True, length=100),
    Field("phone_number", TEXT, length=20),
    Field("hire_date", DATE, required=True),
    Field("job_id", INT, required=True),
    Field("salary", money(), required=True),
    Field("manager_id", INT),
    Field("department_id", INT),
))
DEPENDENTS = Table("dependents", ("dependent_id",), (
    Field("dependent_id", INT, required=True),
    Field("first_name", TEXT, required=True, length=50),
    Field("last_name", TEXT, required=True, length=50),
    Field("relationship", TEXT, required=True, length=25),
    Field("employee_id", INT, required=True),
))
TABLES = {t.name: t for t in (
    REGIONS, COUNTRIES, LOCATIONS, JOBS, DEPARTMENTS, EMPLOYEES, DEPENDENTS,
)}
REFERENCES = (
    Reference("countries", ("region_id",), "regions", ("region_id",)),
    Reference("locations", ("country_id",), "countries", ("country_id",)),
    Reference("departments", ("location_id",), "locations", ("location_id",)),
    Reference("employees", ("job_id",), "jobs", ("job_id",)),
    Reference("employees", ("department_id",), "departments", ("department_id",)),
    Reference("employees", ("manager_id",), "employees", ("employee_id",), cascade=False),
    Reference("dependents", ("employee_id",), "employees", ("employee_id",)),
)

# Warehouse names of the natural keys, silver columns and the gold report.
STAR = Star(
    references=REFERENCES,
    feed=EMPLOYEES,
    dimensions=(
        Dimension("dim_jobs", JOBS, {"job_id": "job_key"}),
        Dimension("dim_employees", EMPLOYEES, {
            "employee_id": "employee_key",
            "job_id": "job_key",
            "manager_id": "manager_key",
            "department_id": "department_key",
        }),
        Dimension("dim_departments", DEPARTMENTS, {
            "department_id": "department_key",
            "location_id": "location_key",
        }),
        Dimension("dim_locations", LOCATIONS, {
            "location_id": "location_key",
            "country_id": "country_key",
        }),
    ),
    hops=(
        Hop("dim_jobs", {"job_id": "job_key"}, {"job_key": "job_key"}),
        Hop("dim_departments", {"department_id": "department_key"}, {
            "department_key": "department_key",
            "department_location": "location_key",
        }),
        Hop("dim_locations", {"department_location": "location_key"}, {
            "location_key": "location_key",
        }),
    ),
    silver={
        "employee_key": "employee_id",
        "job_key": "job_key",
        "department_key": "department_key",
        "location_key": "location_key",
        "hire_date": "hire_date",
        "salary": "salary",
    },
    date="hire_date",
    gold=Band(
        bridge="dim_employees",
        dimension="dim_jobs",
        key="job_key",
        title="job_title",
        measures={
            "avg_min_salary": ("dim", "min_salary"),
            "avg_max_salary": ("dim", "max_salary"),
        },
        order_by="avg_min_salary",
    ),
)
