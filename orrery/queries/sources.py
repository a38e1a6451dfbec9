"""File sources: CSV, inferred schemas with hints, listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.models import trade
from orrery.models.table import DATE, TEXT, money
from orrery.plans.feeds import land_json_arrays
from orrery.queries.registry import load, new_lakehouse, orders_by_day, query
from orrery.session import remove, scratch
from orrery.sources.files import hinted_schema, list_files, read_csv
from orrery.sources.ledger import file_states, note_files
from orrery.streaming.medallion import bronze


@query("""
    SELECT c_custkey, c_name || ', "' || c_mktsegment || '"' AS c_label,
           nullif(c_nationkey, 0) AS c_nationkey, c_acctbal,
           'int' AS nation_type, 'double' AS balance_type
    FROM customer
""")
def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types inferred in spite of quoted commas, quoted quotes and ``NULL`` in a number column."""
    path = scratch(spark, "csv")
    customer = load(spark, sf_dir, "customer").select(
        "c_custkey",
        F.concat("c_name", F.lit(', "'), "c_mktsegment", F.lit('"')).alias("c_label"),
        F.nullif("c_nationkey", F.lit(0)).alias("c_nationkey"),
        "c_acctbal",
    )
    customer.write.options(header=True, nullValue="NULL", escape='"').csv(path)
    rows = read_csv(spark, path)
    return rows.withColumns({
        "c_custkey": F.col("c_custkey").cast("long"),
        "nation_type": F.typeof("c_nationkey"),
        "balance_type": F.typeof("c_acctbal"),
    })


@query("""
    SELECT o_orderkey, o_custkey, o_totalprice, cast(o_orderdate AS date) AS o_orderdate,
           cast(NULL AS varchar) AS o_comment, 'bigint' AS key_type,
           'decimal(18,2)' AS price_type, 'date' AS date_type
    FROM orders
""")
def schema_hints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inferred from all files, retyped by hints, kept; a stream then starts with what was kept."""
    path, kept = scratch(spark, "hints"), scratch(spark, "schema")
    land_json_arrays(orders_by_day(spark, sf_dir), path)
    hints = {"o_totalprice": money(18), "o_orderdate": DATE, "o_comment": TEXT}
    hinted_schema(spark, path, hints, kept)
    place = new_lakehouse(spark, "hints")
    table = place.table("fact_bronze")
    bronze(spark, path, hinted_schema(spark, path, {}, kept), table, place.checkpoint("bronze"))
    return spark.table(table).select(
        "o_orderkey", "o_custkey", F.col("o_totalprice").cast("double").alias("o_totalprice"),
        "o_orderdate", "o_comment",
        F.typeof("o_orderkey").alias("key_type"),
        F.typeof("o_totalprice").alias("price_type"),
        F.typeof("o_orderdate").alias("date_type"),
    )


@query("""
    SELECT lang, cast(sum(octet_length(encode(text)) + 1) AS bigint) AS total_bytes
    FROM documents GROUP BY lang
""")
def list_source_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes of the text files found per language folder: every text and its line end."""
    path = scratch(spark, "listing")
    load(spark, sf_dir, "documents").select("lang", F.col("text").alias("value")).write.partitionBy(
        "lang"
    ).text(path)
    files = list_files(spark, path, "*.txt")
    return files.groupBy(F.regexp_extract("path", "lang=([^/]+)/", 1).alias("lang")).agg(
        F.sum("length").alias("total_bytes")
    )


@query("""
    WITH years AS (SELECT cast(year(o_orderdate) AS integer) AS y, count(*) AS n FROM orders GROUP BY ALL),
         first AS (SELECT min(y) AS y FROM years)
    SELECT years.y AS order_year,
           CASE years.y - first.y WHEN 0 THEN 'rewritten' WHEN 1 THEN 'vanished' ELSE 'taken' END AS state,
           n AS n_rows, cast(1 AS bigint) AS first_look
    FROM years, first
    UNION ALL SELECT 9999, 'skipped', 0, 2
""")
def feed_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of a feed by year: after they were taken in, those of the first are rewritten, those of the second go and some
    come that nothing has taken in yet. A year comes as more files the larger it is."""
    place, folder = new_lakehouse(spark, "ledger"), scratch(spark, "feed")
    ledger, table = place.table("feed_files"), place.table("fact_bronze")
    orders = orders_by_day(spark, sf_dir).withColumn("y", F.year("o_orderdate"))
    orders.hint("rebalance", "y").write.partitionBy("y").json(folder)
    note_files(spark, folder, ledger, "*.json")
    bronze(spark, folder, trade.ORDERS.schema, table, place.checkpoint("bronze"), multi_line=False)
    first = orders.agg(F.min("y")).first()[0]
    again = scratch(spark, "again")
    twice = orders.where(F.col("y") == first).unionByName(orders.where(F.col("y") == first)).drop("y")
    twice.repartition(len(_files(spark, f"{folder}/y={first}"))).write.json(again)
    _replace(spark, again, f"{folder}/y={first}")
    remove(spark, f"{folder}/y={first + 1}", below=folder)
    orders.where(F.col("y") == first).withColumn("y", F.lit(9999)).write.mode("append").partitionBy("y").json(folder)
    note_files(spark, folder, ledger, "*.json")
    states = file_states(spark, ledger, spark.table(table))
    year = F.regexp_extract("path", "y=([0-9]+)/", 1).cast("int").alias("order_year")
    # A year may have come as several files.
    return states.select(year, "state", "n_rows", "first_look").groupBy("order_year", "state", "first_look").agg(
        F.sum("n_rows").alias("n_rows")
    )


def _files(spark: SparkSession, folder: str) -> list[str]:
    return sorted(r["path"] for r in list_files(spark, folder, "*.json").select("path").collect())


def _replace(spark: SparkSession, source: str, target: str) -> None:
    """Put the files of a folder in the place of as many files of another, under their names."""
    for new, old in zip(_files(spark, source), _files(spark, target), strict=True):
        new, old = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (new, old))
        files = old.getFileSystem(spark._jsc.hadoopConfiguration())
        files.delete(old, False)
        files.rename(new, old)
