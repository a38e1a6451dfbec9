"""Relational sources. Hosts, credentials and drivers are always arguments."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Split:
    """How a scan is cut into parallel range queries.

    The column is a number, a date or a timestamp. The bounds only place the cuts: rows below, above or null still arrive, in the outer parts.
    """

    column: str
    lower: object
    upper: object
    parts: int


def mysql_url(host: str, port: int, database: str) -> str:
    return f"jdbc:mysql://{host}:{port}/{database}"


def as_table(query: str) -> str:
    """A query in the place of a table name: parenthesised and aliased. A bare name stays."""
    text = query.strip().rstrip(";")
    words = text.split(None, 1)
    if words and words[0].lower() in ("select", "with"):
        return f"({text}) q"
    return f"{text} q" if text.startswith("(") and text.endswith(")") else text


def scan_query(
    spark: SparkSession,
    url: str,
    query: str,
    properties: dict[str, str],
    split: Split | None = None,
    predicates: list[str] | None = None,
) -> DataFrame:
    """Lazy scan of a table or query; filters and columns chosen later are pushed down.

    Without ``split`` or ``predicates`` one connection reads everything, which suits only small
    dimensions. ``predicates`` gives one part per condition, for a key whose values crowd in a
    few ranges.
    """
    table = as_table(query)
    if predicates:
        return spark.read.jdbc(url, table, predicates=predicates, properties=properties)
    if split:
        # As options the bounds stay text, so that dates and timestamps pass too.
        bounds = {
            "partitionColumn": split.column, "lowerBound": str(split.lower), "upperBound": str(split.upper),
            "numPartitions": str(split.parts),
        }
        return spark.read.format("jdbc").options(**properties, url=url, dbtable=table, **bounds).load()
    return spark.read.jdbc(url, table, properties=properties)


def key_range(
    spark: SparkSession, url: str, query: str, column: str, parts: int, properties: dict[str, str]
) -> Split | None:
    """Bounds for a parallel scan, asked of the database itself: one row comes back."""
    bounds = f"(select min({column}) as lo, max({column}) as hi from {as_table(query)}) b"
    row = spark.read.jdbc(url, bounds, properties=properties).first()
    if row is None or row[0] is None:
        return None
    return Split(column, row[0], row[1], parts)


def create_view(spark: SparkSession, view: str, url: str, table: str, **options: str) -> DataFrame:
    """Temporary view over a remote table or view; nothing is read until it is queried."""
    given = {"url": url, "dbtable": as_table(table), **options}
    listed = ", ".join(f"`{key}` '{_quoted(value)}'" for key, value in given.items())
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY VIEW {view} USING org.apache.spark.sql.jdbc OPTIONS ({listed})"
    )
    return spark.table(view)


def _quoted(value: str) -> str:
    return str(value).replace("\\", "\\\\").replace("'", "\\'")
