"""Made-up human-resources rows in the shape of the operational tables."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from orrery.models import staff

REGIONS = [(1, "North"), (2, "South")]
COUNTRIES = [("AA", "Aland", 1), ("BB", "Beland", 2)]
LOCATIONS = [
    (10, "1 Hill Road", "X1Y 2Z3", "Ashby", None, "AA"),
    (20, "Unit 2, Low Street", "00123", "Borley", "Kent", "BB"),
]
JOBS = [
    (1, "Clerk", Decimal("2000.00"), Decimal("5000.00")),
    (2, "Planner", Decimal("4000.50"), Decimal("9000.00")),
    (3, "Clerk", Decimal("3000.00"), Decimal("6000.00")),
    (4, "Director", None, Decimal("40000.00")),
]
DEPARTMENTS = [(1, "Stores", 10), (2, "Works", 20), (3, "Projects", None)]
EMPLOYEES = [
    (100, "Ada", "Moss", "ada moss@example.org", None, date(1990, 2, 28), 4, "30000.00", None, 2),
    (101, "Ben", "Nye", "ben@example.org", "555 1", date(1999, 8, 31), 1, "2100.00", 100, 1),
    (102, "Cy", "Orr", "cy@example.org", "555 2", date(2000, 1, 1), 1, "2200.50", 101, 1),
    (103, "Di", "Pym", "di@example.org", "555 3", date(2000, 2, 29), 3, "3300.00", 101, 2),
    (104, "Ed", "Quy", "ed@example.org", None, date(2001, 5, 5), 2, "5000.00", 100, 3),
    (105, "Flo", "Ray", "flo@example.org", "555 5", date(2002, 6, 6), 2, "5100.00", 100, None),
]
DEPENDENTS = [(1, "Gus", "Moss", "Child", 100), (2, "Hal", "Nye", "Child", 101)]


def tables(spark: SparkSession) -> dict[str, DataFrame]:
    people = [(*e[:7], Decimal(e[7]), *e[8:]) for e in EMPLOYEES]
    rows = {
        "regions": REGIONS, "countries": COUNTRIES, "locations": LOCATIONS, "jobs": JOBS,
        "departments": DEPARTMENTS, "employees": people, "dependents": DEPENDENTS,
    }
    return {
        name: spark.createDataFrame(rows[name], table.schema)
        for name, table in staff.TABLES.items()
    }
