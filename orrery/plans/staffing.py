"""The human-resources lakehouse from its own kinds of sources."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from orrery.models import staff
from orrery.plans.warehouse import Lakehouse, rebuild, refresh
from orrery.sources.files import read_csv, read_json
from orrery.sources.jdbc import scan_query


@dataclass(frozen=True)
class Sources:
    """Where the rows come from. ``jdbc`` holds user, password and driver, given at run time."""

    url: str
    jdbc: dict[str, str]
    departments: str
    locations: str
    employees: str


def read_sources(spark: SparkSession, sources: Sources) -> dict[str, DataFrame]:
    """Jobs from a database, departments and employees from JSON documents, locations from CSV."""
    return {
        "jobs": scan_query(spark, sources.url, staff.JOBS.name, sources.jdbc),
        "departments": read_json(spark, sources.departments, staff.DEPARTMENTS.schema),
        "employees": read_json(spark, sources.employees, staff.EMPLOYEES.schema),
        "locations": read_csv(spark, sources.locations, staff.LOCATIONS.schema),
    }


def build(
    spark: SparkSession, place: Lakehouse, sources: Sources, feed: str
) -> tuple[Lakehouse, DataFrame]:
    """The lakehouse from nothing, and the average salary band per job title, lowest first."""
    return rebuild(spark, staff.STAR, place, read_sources(spark, sources), feed)


def update(spark: SparkSession, place: Lakehouse, sources: Sources, feed: str) -> DataFrame:
    """The same report after the dimensions and whatever came into the feed since.

    Earlier employees whose job, department or location was unknown then are tried again.
    """
    return refresh(spark, staff.STAR, place, read_sources(spark, sources), feed, late=True)
