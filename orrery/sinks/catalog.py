"""Databases and tables of the session catalog.

The table format is an argument; parquet is the default because it needs no extra jar.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FORMAT = "parquet"

#: Of partitions written on their own, which hold most of a lakehouse: a fifth to a quarter less disk than Spark's default.
COMPRESSION = "zstd"


def create_database(
    spark: SparkSession,
    database: str,
    location: str,
    comment: str = "",
    properties: dict[str, str] | None = None,
) -> None:
    """Create the database unless it exists; its tables then live below ``location``."""
    statement = (
        f"CREATE DATABASE IF NOT EXISTS `{database}` COMMENT {_text(comment)} "
        f"LOCATION {_text(location)}"
    )
    if properties:
        listed = ", ".join(f"{_text(k)} = {_text(v)}" for k, v in properties.items())
        statement += f" WITH DBPROPERTIES ({listed})"
    spark.sql(statement)


def drop_database(spark: SparkSession, database: str) -> None:
    """Drop the database with all its tables; nothing happens if it does not exist."""
    spark.sql(f"DROP DATABASE IF EXISTS `{database}` CASCADE")


def describe_database(spark: SparkSession, database: str) -> DataFrame:
    return spark.sql(f"DESCRIBE DATABASE EXTENDED `{database}`")


def create_table_as(
    spark: SparkSession,
    table: str,
    rows: DataFrame,
    location: str,
    comment: str = "",
    format: str = FORMAT,
) -> None:
    """Create an external table from ``rows`` unless it exists.

    An existing table is left as it is, whatever ``rows`` holds now; refresh with
    ``overwrite_table``.
    """
    if spark.catalog.tableExists(table):
        return
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} USING {format} COMMENT {_text(comment)} "
        f"LOCATION {_text(location)} AS SELECT * FROM {{rows}}",
        rows=rows,
    )


def overwrite_table(
    rows: DataFrame,
    table: str,
    format: str = FORMAT,
    bucket_by: tuple[int, str] | None = None,
) -> None:
    """Replace the table, its schema included.

    ``bucket_by`` (buckets, key) stores the rows hashed and sorted by a key: two large tables
    with the same buckets are then joined on it without a shuffle. A bucket is never split, so
    the key should have no hot value.
    """
    writer = rows.write.format(format).mode("overwrite")
    if bucket_by:
        buckets, key = bucket_by
        writer = writer.bucketBy(buckets, key).sortBy(key)
    writer.saveAsTable(table)


def insert_rows(rows: DataFrame, table: str) -> None:
    """Append to an existing table, column by column name."""
    target = rows.sparkSession.table(table)
    rows.select(*target.columns).write.insertInto(table)


def create_table(
    spark: SparkSession,
    table: str,
    like: DataFrame,
    format: str = FORMAT,
    partition_by: list[str] | None = None,
) -> None:
    """An empty table with the columns and types of ``like``, of which the last ones may partition it."""
    empty = spark.createDataFrame([], like.schema)
    empty.write.format(format).partitionBy(*(partition_by or [])).saveAsTable(table)


def add_columns(spark: SparkSession, table: str, fields: list[T.StructField]) -> None:
    """New columns of an existing table; its rows have null there."""
    if fields:
        listed = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in fields)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({listed})")


def overwrite_partition(
    spark: SparkSession, rows: DataFrame, table: str, values: dict[str, int], format: str = FORMAT
) -> None:
    """Replace one partition of a table, column by column name; other partitions stay as they are.

    The partition's folder is written on its own, so the rows may come from other partitions of the same table.
    ``spark`` is the session that is to see it; the rows of a micro-batch belong to one of their own.
    """
    kinds = [f for f in spark.table(table).schema.fields if f.name not in values]
    known = table_properties(spark, table)
    folder = "/".join([known["Location"].rstrip("/"), *[f"{c}={int(v)}" for c, v in values.items()]])
    rows.select(*[F.col(f"`{f.name.replace('`', '``')}`").cast(f.dataType).alias(f.name) for f in kinds]).write.format(
        format
    ).options(**({"compression": COMPRESSION} if format == FORMAT else {})).mode("overwrite").save(folder)
    if known.get("Partition Provider") == "Catalog":
        where = ", ".join(f"{c} = {int(v)}" for c, v in values.items())
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({where})")
    spark.catalog.refreshTable(table)


def point_table(spark: SparkSession, table: str, schema: T.StructType, folder: str, format: str = FORMAT) -> None:
    """Let a table read another folder from now on. Its files stay: they are the caller's.

    A table with other columns, or one whose files are its own, is dropped and created again.
    """
    same = spark.catalog.tableExists(table) and table_properties(spark, table).get("Type") == "EXTERNAL"
    if same and [(f.name, f.dataType) for f in spark.table(table).schema] == [(f.name, f.dataType) for f in schema]:
        spark.sql(f"ALTER TABLE {table} SET LOCATION {_text(folder)}")
    else:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        listed = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema)
        spark.sql(f"CREATE TABLE {table} ({listed}) USING {format} LOCATION {_text(folder)}")
    spark.catalog.refreshTable(table)


def partition_values(spark: SparkSession, table: str, column: str) -> list[int]:
    """The values of an integer partition column, from the catalog: no file is read."""
    listed = spark.sql(f"SHOW PARTITIONS {table}").collect()
    return [int(part.split("=")[1]) for row in listed for part in row[0].split("/") if part.startswith(f"{column}=")]


def table_properties(spark: SparkSession, table: str) -> dict[str, str]:
    """What the catalog notes of a table besides its columns, such as ``Location``."""
    return {r["col_name"]: r["data_type"] for r in describe_table(spark, table).collect()}


def use_database(spark: SparkSession, database: str) -> None:
    spark.sql(f"USE `{database}`")


def show_tables(spark: SparkSession, database: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN `{database}`").filter("NOT isTemporary")


def describe_table(spark: SparkSession, table: str) -> DataFrame:
    """Columns, then partitioning, location, format and comment of a table or view."""
    return spark.sql(f"DESCRIBE EXTENDED {table}")


def _text(value: str) -> str:
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"
