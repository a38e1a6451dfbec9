from __future__ import annotations

from datetime import date, timedelta

import pytest

from orrery.operators.dates import date_dim, date_dim_extend, date_dim_of


def day(frame, when: str) -> dict:
    return frame.filter(f"full_date = DATE'{when}'").first().asDict()


@pytest.fixture(scope="module")
def decade(spark):
    return date_dim(spark, "2000-01-01", "2010-12-31").cache()


def test_one_row_per_day_both_ends_included(decade):
    assert decade.count() == 4018
    assert decade.select("date_key").distinct().count() == 4018
    assert len(decade.columns) == 23


def test_first_day(decade):
    # The known first row of the date dimension.
    assert tuple(decade.orderBy("date_key").first()) == (
        20000101, date(2000, 1, 1), "2000/01/01", "01/01/2000", "01/01/2000", 7, "Saturday", 1, 1,
        "Weekend", 52, "January", 1, "N", 1, 2000, "2000-01", "2000Q1", 7, 3, 2000, "2000-07",
        "2000Q3",
    )


def test_leap_day_is_last_of_month(decade):
    row = day(decade, "2000-02-29")
    assert (row["is_last_day_of_month"], row["day_of_year"]) == ("Y", 60)
    assert day(decade, "2000-02-28")["is_last_day_of_month"] == "N"
    assert day(decade, "2001-02-28")["is_last_day_of_month"] == "Y"


def test_fiscal_month_clamps_and_rolls_over(decade):
    row = day(decade, "2000-08-31")
    assert (row["fiscal_year_month"], row["fiscal_year_qtr"]) == ("2001-02", "2001Q1")
    assert day(decade, "2000-06-30")["fiscal_year"] == 2000
    assert day(decade, "2000-07-01")["fiscal_year"] == 2001


def test_iso_weeks_at_year_ends(decade):
    assert day(decade, "2004-12-31")["week_of_year"] == 53
    assert day(decade, "2008-12-29")["week_of_year"] == 1


def test_negative_offset(spark):
    row = day(date_dim(spark, "2010-01-15", "2010-01-15", fiscal_offset=-6), "2010-01-15")
    assert (row["fiscal_month_of_year"], row["fiscal_year"]) == (7, 2009)


def test_begin_after_end_gives_no_days(spark):
    assert date_dim(spark, "2001-01-02", "2001-01-01").count() == 0


def test_every_attribute_against_python(decade):
    for row in decade.collect():
        d = row.full_date
        assert row.date_key == int(d.strftime("%Y%m%d"))
        assert row.day_name_of_week == d.strftime("%A")
        assert row.month_name == d.strftime("%B")
        assert row.day_of_week == d.isoweekday() % 7 + 1
        assert row.week_of_year == d.isocalendar().week
        assert (row.weekday_weekend == "Weekend") == (d.weekday() >= 5)
        assert (row.is_last_day_of_month == "Y") == ((d + timedelta(days=1)).day == 1)


def test_span_of_facts_covers_every_date(spark):
    facts = spark.createDataFrame([(date(1987, 6, 17),), (None,), (date(2000, 1, 4),)], "d date")
    dim = date_dim_of(facts, "d")
    assert dim.count() == (date(2000, 1, 4) - date(1987, 6, 17)).days + 1
    assert date_dim_of(facts.limit(0), "d").count() == 0


def test_extension_adds_new_days_and_reports_known_ones(spark):
    had = date_dim(spark, "2000-01-01", "2000-01-10")
    added, rejected = date_dim_extend(had, date_dim(spark, "2000-01-08", "2000-01-12"))
    assert sorted(r.date_key for r in added.collect()) == [20000111, 20000112]
    assert sorted(r.date_key for r in rejected.collect()) == [20000108, 20000109, 20000110]
