"""Calendar and fiscal attributes of a day, and the integer date key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Column names of the date dimension and the text formats of its labels.
DATE_NAME = "yyyy/MM/dd"
DATE_NAME_US = "MM/dd/yyyy"
DATE_NAME_EU = "dd/MM/yyyy"
YEAR_MONTH = "yyyy-MM"
WEEKEND_DAYS = (1, 7)  # Sunday is day 1
FISCAL_OFFSET_MONTHS = 6


def date_key(day: Column) -> Column:
    """20000131 for 31 January 2000."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.day(day)).cast("int")


def year_quarter(day: Column) -> Column:
    return F.concat(F.year(day).cast("string"), F.lit("Q"), F.quarter(day).cast("string"))


def day_attributes(day: Column, fiscal_offset: int = FISCAL_OFFSET_MONTHS) -> list[Column]:
    """The date dimension's 23 columns for one day.

    The fiscal columns describe the day moved by ``fiscal_offset`` months, clamped to the end of
    a shorter month; the offset may be negative.
    """
    fiscal = F.add_months(day, fiscal_offset)
    attributes = {
        "date_key": date_key(day),
        "full_date": day,
        "date_name": F.date_format(day, DATE_NAME),
        "date_name_us": F.date_format(day, DATE_NAME_US),
        "date_name_eu": F.date_format(day, DATE_NAME_EU),
        "day_of_week": F.dayofweek(day),
        "day_name_of_week": F.date_format(day, "EEEE"),
        "day_of_month": F.dayofmonth(day),
        "day_of_year": F.dayofyear(day),
        "weekday_weekend": F.when(F.dayofweek(day).isin(*WEEKEND_DAYS), "Weekend").otherwise(
            "Weekday"
        ),
        "week_of_year": F.weekofyear(day),
        "month_name": F.date_format(day, "MMMM"),
        "month_of_year": F.month(day),
        "is_last_day_of_month": F.when(day == F.last_day(day), "Y").otherwise("N"),
        "calendar_quarter": F.quarter(day),
        "calendar_year": F.year(day),
        "calendar_year_month": F.date_format(day, YEAR_MONTH),
        "calendar_year_qtr": year_quarter(day),
        "fiscal_month_of_year": F.month(fiscal),
        "fiscal_quarter": F.quarter(fiscal),
        "fiscal_year": F.year(fiscal),
        "fiscal_year_month": F.date_format(fiscal, YEAR_MONTH),
        "fiscal_year_qtr": year_quarter(fiscal),
    }
    return [value.alias(name) for name, value in attributes.items()]
