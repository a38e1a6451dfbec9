"""Date dimension, its extension, key lookup, and the date functions it is made of."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.functions.calendar import date_key, day_attributes
from orrery.models import trade
from orrery.operators.dates import date_dim_extend as extend
from orrery.operators.dates import date_dim_of
from orrery.plans.warehouse import land_dates
from orrery.queries.registry import load, new_lakehouse, query


def _attributes_sql(day: str) -> str:
    fiscal = f"({day} + INTERVAL 6 MONTH)"
    return f"""
        cast(year({day}) * 10000 + month({day}) * 100 + day({day}) AS integer) AS date_key,
        cast({day} AS date) AS full_date,
        strftime({day}, '%Y/%m/%d') AS date_name,
        strftime({day}, '%m/%d/%Y') AS date_name_us,
        strftime({day}, '%d/%m/%Y') AS date_name_eu,
        cast(dayofweek({day}) + 1 AS integer) AS day_of_week,
        dayname({day}) AS day_name_of_week,
        cast(day({day}) AS integer) AS day_of_month,
        cast(dayofyear({day}) AS integer) AS day_of_year,
        CASE WHEN dayofweek({day}) IN (0, 6) THEN 'Weekend' ELSE 'Weekday' END AS weekday_weekend,
        cast(weekofyear({day}) AS integer) AS week_of_year,
        monthname({day}) AS month_name,
        cast(month({day}) AS integer) AS month_of_year,
        CASE WHEN cast({day} AS date) = last_day({day}) THEN 'Y' ELSE 'N' END
            AS is_last_day_of_month,
        cast(quarter({day}) AS integer) AS calendar_quarter,
        cast(year({day}) AS integer) AS calendar_year,
        strftime({day}, '%Y-%m') AS calendar_year_month,
        year({day}) || 'Q' || quarter({day}) AS calendar_year_qtr,
        cast(month({fiscal}) AS integer) AS fiscal_month_of_year,
        cast(quarter({fiscal}) AS integer) AS fiscal_quarter,
        cast(year({fiscal}) AS integer) AS fiscal_year,
        strftime({fiscal}, '%Y-%m') AS fiscal_year_month,
        year({fiscal}) || 'Q' || quarter({fiscal}) AS fiscal_year_qtr
    """


def _days_sql(table: str, column: str) -> str:
    return f"""
        SELECT cast(unnest(generate_series(
            cast(min({column}) AS date)::timestamp, cast(max({column}) AS date)::timestamp,
            INTERVAL 1 DAY)) AS date) AS d
        FROM {table}
    """


@query(f"SELECT {_attributes_sql('d')} FROM ({_days_sql('orders', 'o_orderdate')})")
def date_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar from the first to the last order date."""
    return date_dim_of(load(spark, sf_dir, "orders"), "o_orderdate")


@query(f"""
    WITH had AS ({_days_sql('orders', 'o_orderdate')}),
         wanted AS ({_days_sql('lineitem', 'l_shipdate')})
    SELECT strftime(d, '%Y%m%d')::integer AS date_key, d AS full_date,
           CASE WHEN d IN (SELECT d FROM had) THEN 'rejected' ELSE 'added' END AS outcome
    FROM wanted
""")
def date_dim_extend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A calendar of order dates extended by the ship dates: new days, and days it has already."""
    had = date_dim_of(load(spark, sf_dir, "orders"), "o_orderdate")
    wanted = date_dim_of(load(spark, sf_dir, "lineitem"), "l_shipdate")
    added, rejected = extend(had, wanted)
    return added.select("date_key", "full_date", F.lit("added").alias("outcome")).unionByName(
        rejected.select("date_key", "full_date", F.lit("rejected").alias("outcome"))
    )


@query(f"""
    SELECT {_attributes_sql('d')}
    FROM ({_days_sql('orders', 'o_orderdate')} UNION {_days_sql('lineitem', 'l_shipdate')})
""")
def date_dim_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored date dimension after facts of two kinds have come in."""
    place = new_lakehouse(spark, "dates")
    for table, column in (("orders", "o_orderdate"), ("lineitem", "l_shipdate")):
        facts = load(spark, sf_dir, table).select(F.to_date(column).alias(trade.STAR.date))
        land_dates(trade.STAR, place, facts)
    return spark.table(place.table("dim_date"))


@query(f"""
    WITH dates AS (
        SELECT {_attributes_sql('d')} FROM ({_days_sql('orders', 'o_orderdate')})
    )
    SELECT o_orderkey, date_key, fiscal_year_qtr, weekday_weekend
    FROM orders JOIN dates ON cast(o_orderdate AS date) = full_date
""")
def date_key_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order's date key, and attributes found through it."""
    orders = load(spark, sf_dir, "orders")
    dates = date_dim_of(orders, "o_orderdate").select(
        "date_key", "fiscal_year_qtr", "weekday_weekend"
    )
    keyed = orders.select("o_orderkey", date_key(F.to_date("o_orderdate")).alias("date_key"))
    return keyed.join(dates, "date_key")


@query(f"SELECT o_orderkey, {_attributes_sql('o_orderdate')} FROM orders")
def date_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar functions on every order's own date."""
    orders = load(spark, sf_dir, "orders")
    return orders.select("o_orderkey", *day_attributes(F.to_date("o_orderdate")))
