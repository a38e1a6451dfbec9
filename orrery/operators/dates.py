"""The date dimension: generated from bounds or from the dates of a fact, and extended."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.functions.calendar import FISCAL_OFFSET_MONTHS, day_attributes


def date_dim(
    spark: SparkSession,
    begin: date | str,
    end: date | str,
    fiscal_offset: int = FISCAL_OFFSET_MONTHS,
) -> DataFrame:
    """One row per day from ``begin`` to ``end``, both included; none when begin is after end."""
    span = spark.range(1).select(
        F.lit(str(begin)).cast("date").alias("begin"), F.lit(str(end)).cast("date").alias("end")
    )
    return _calendar(span, fiscal_offset)


def date_dim_of(
    facts: DataFrame, column: str, fiscal_offset: int = FISCAL_OFFSET_MONTHS
) -> DataFrame:
    """The date dimension that covers every date of ``column``."""
    day = F.col(column).cast("date")
    return _calendar(facts.agg(F.min(day).alias("begin"), F.max(day).alias("end")), fiscal_offset)


def date_dim_extend(existing: DataFrame, wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The wanted days that are new, and those rejected because their key is already there."""
    known = existing.select("date_key")
    return (
        wanted.join(known, "date_key", "left_anti"),
        wanted.join(known, "date_key", "left_semi"),
    )


def _calendar(span: DataFrame, fiscal_offset: int) -> DataFrame:
    # a calendar is bounded by its years, so one task can list its days
    every_day = F.sequence("begin", "end", F.expr("interval 1 day"))
    days = span.select(F.explode(F.when(F.col("begin") <= F.col("end"), every_day)).alias("day"))
    return days.select(*day_attributes(F.col("day"), fiscal_offset))
