"""Bronze, silver and gold over a JSON feed of orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orrery.models import trade
from orrery.operators.preview import preview_stream
from orrery.plans.feeds import land_json_arrays, land_json_lines
from orrery.plans.warehouse import Lakehouse, land_dimensions, rebuild, refresh, take_in
from orrery.queries.registry import exact_avg, load, new_lakehouse, orders_by_day, query
from orrery.session import scratch
from orrery.sinks.catalog import overwrite_table
from orrery.streaming.medallion import (
    as_version, bronze, dims_of, evolve, gold, quarantine, read_feed, replay, with_identity,
)


def _sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {d.source.name: load(spark, sf_dir, d.source.name) for d in trade.STAR.dimensions}


def _feed(spark: SparkSession, sf_dir: str) -> str:
    folder = scratch(spark, "feed")
    land_json_arrays(orders_by_day(spark, sf_dir), folder)
    return folder


def _plain(silver_rows: DataFrame) -> DataFrame:
    return silver_rows.withColumn("total_price", F.col("total_price").cast("double"))


_SILVER_SQL = """
    SELECT o_orderkey AS order_key, c_custkey AS customer_key, n_nationkey AS nation_key,
           r_regionkey AS region_key, cast(o_orderdate AS date) AS order_date,
           o_totalprice AS total_price
    FROM orders
    JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey
"""

_GOLD_SQL = f"""
    SELECT n_name, {exact_avg('s_acctbal')} AS avg_supplier_balance,
           {exact_avg('total_price')} AS avg_order_price
    FROM ({_SILVER_SQL}) fact
    JOIN supplier ON nation_key = s_nationkey
    JOIN nation ON s_nationkey = n_nationkey
    GROUP BY n_name
    ORDER BY avg_supplier_balance, n_name
"""


@query("""
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
           cast(o_orderdate AS date) AS o_orderdate, o_orderpriority,
           cast(NULL AS varchar) AS rescued, true AS has_ingest_ts, true AS from_feed
    FROM orders
""")
def stream_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows; the ingestion time is only checked to be there, the file to be a feed file."""
    place = new_lakehouse(spark, "bronze")
    feed, table = _feed(spark, sf_dir), place.table("fact_bronze")
    bronze(spark, feed, trade.ORDERS.schema, table, place.checkpoint("bronze"))
    return spark.table(table).select(
        *[c for c in trade.ORDERS.columns if c != "o_totalprice"],
        F.col("o_totalprice").cast("double").alias("o_totalprice"),
        "rescued",
        F.col("ingest_ts").isNotNull().alias("has_ingest_ts"),
        F.col("source_file").contains(feed.rsplit("/", 1)[-1]).alias("from_feed"),
    )


@query(_SILVER_SQL)
def stream_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = new_lakehouse(spark, "silver")
    tables = land_dimensions(spark, trade.STAR, place, _sources(spark, sf_dir))
    return _plain(take_in(spark, trade.STAR, place, _feed(spark, sf_dir), tables))


@query(_SILVER_SQL)
def stream_silver_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from a feed with one document per line, whose files Spark can split."""
    place, folder = new_lakehouse(spark, "lines"), scratch(spark, "feed")
    orders_by_day(spark, sf_dir).write.json(folder)
    tables = land_dimensions(spark, trade.STAR, place, _sources(spark, sf_dir))
    return _plain(take_in(spark, trade.STAR, place, folder, tables, multi_line=False))


@query(f"""
    SELECT *, (SELECT count(*) FROM orders) AS bronze_rows FROM ({_SILVER_SQL})
""")
def stream_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second run takes in only the files that came since, a third one nothing."""
    place = new_lakehouse(spark, "resume")
    tables = land_dimensions(spark, trade.STAR, place, _sources(spark, sf_dir))
    orders, folder = orders_by_day(spark, sf_dir), scratch(spark, "feed")
    land_json_arrays(orders.filter("o_orderdate < DATE'1998-01-01'"), folder)
    take_in(spark, trade.STAR, place, folder, tables, max_files=2)
    land_json_arrays(orders.filter("coalesce(o_orderdate >= DATE'1998-01-01', true)"), folder)
    for _ in range(2):
        rows = take_in(spark, trade.STAR, place, folder, tables, max_files=2)
    taken = spark.table(place.table("fact_bronze")).count()
    return _plain(rows).withColumn("bronze_rows", F.lit(taken).cast("long"))


@query(_GOLD_SQL)
def gold_from_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = new_lakehouse(spark, "gold")
    tables = land_dimensions(spark, trade.STAR, place, _sources(spark, sf_dir))
    fact = take_in(spark, trade.STAR, place, _feed(spark, sf_dir), tables)
    return gold(fact, tables, trade.STAR.gold, place.table("fact_gold"))


@query(_GOLD_SQL)
def full_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything from its sources; tables and checkpoints of an earlier build are left behind."""
    place = new_lakehouse(spark, "rebuild")
    overwrite_table(load(spark, sf_dir, "nation"), place.table("fact_gold"))
    _, report = rebuild(spark, trade.STAR, place, _sources(spark, sf_dir), _feed(spark, sf_dir))
    return report


def _late_customers(
    spark: SparkSession, sf_dir: str
) -> tuple[Lakehouse, str, dict[str, DataFrame]]:
    """Silver built while the customers of one market segment were not yet known."""
    place, feed = new_lakehouse(spark, "late"), _feed(spark, sf_dir)
    sources = _sources(spark, sf_dir)
    early = {**sources, "customer": sources["customer"].filter("c_mktsegment <> 'MACHINERY'")}
    tables = land_dimensions(spark, trade.STAR, place, early)
    take_in(spark, trade.STAR, place, feed, tables)
    return place, feed, tables


@query("""
    SELECT o_orderkey, '0,1,2' AS missing
    FROM orders JOIN customer ON o_custkey = c_custkey
    WHERE c_mktsegment = 'MACHINERY'
""")
def silver_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows waiting for a dimension row; without a customer no nation is reached either."""
    place, _, tables = _late_customers(spark, sf_dir)
    waiting = quarantine(
        spark.table(place.table("fact_bronze")), dims_of(trade.STAR.hops, tables)
    )
    return waiting.select(
        "o_orderkey", F.array_join(F.col("missing").cast("array<string>"), ",").alias("missing")
    )


@query(f"""
    SELECT s.*, c_mktsegment = 'MACHINERY' AS came_late
    FROM ({_SILVER_SQL}) s JOIN customer ON customer_key = c_custkey
""")
def silver_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The waiting rows reach silver once their customers are there, and only once."""
    place, feed, _ = _late_customers(spark, sf_dir)
    tables = land_dimensions(spark, trade.STAR, place, _sources(spark, sf_dir))
    for _ in range(2):
        rows = take_in(spark, trade.STAR, place, feed, tables, late=True)
    replayed = spark.table(place.table("fact_silver_late")).select(
        F.col("order_key").alias("late_key")
    )
    marked = rows.join(replayed, rows["order_key"] == replayed["late_key"], "left")
    return _plain(marked.withColumn("came_late", F.col("late_key").isNotNull()).drop("late_key"))


@query("""
    SELECT o_orderkey, o_orderdate < DATE '1998-01-01' AS early,
           CASE WHEN early THEN NULL ELSE o_orderpriority END AS o_orderpriority,
           CASE WHEN early THEN o_orderpriority END AS rescued_priority,
           o_orderpriority AS filled_priority,
           CASE WHEN o_orderkey % 7 = 0
                THEN cast(cast(o_totalprice AS decimal(18, 3)) + 0.001 AS varchar) END AS rescued_price,
           CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice END AS o_totalprice,
           CASE WHEN o_orderkey % 11 = 0
                THEN strftime(o_orderdate, '%Y-%m-%d') || 'T10:20:30' END AS rescued_date,
           CASE WHEN o_orderkey % 11 <> 0 THEN cast(o_orderdate AS date) END AS o_orderdate,
           CASE WHEN early THEN 1 ELSE 2 END AS schema_version
    FROM orders
""")
def stream_rescued(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A field that the schema lacks is rescued, and a column from the next version of the schema on.

    Prices with a third decimal and dates with a time of day are rescued too, since their columns can't hold them.
    """
    place, folder = new_lakehouse(spark, "rescued"), scratch(spark, "feed")
    orders = load(spark, sf_dir, "orders")
    early = F.col("o_orderdate") < F.lit("1998-01-01").cast("date")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    documents = orders.select(
        early.alias("early"),
        *[c for c in trade.ORDERS.columns if c not in ("o_totalprice", "o_orderdate")],
        (F.col("o_totalprice").cast("decimal(18,3)") + F.when(F.col("o_orderkey") % 7 == 0, F.lit("0.001").cast("decimal(18,3)"))
         .otherwise(F.lit(0).cast("decimal(18,3)"))).alias("o_totalprice"),
        F.when(F.col("o_orderkey") % 11 == 0, F.concat(day, F.lit("T10:20:30"))).otherwise(day).alias("o_orderdate"),
    )
    declared = T.StructType([f for f in trade.ORDERS.schema.fields if f.name != "o_orderpriority"])
    table, versions = place.table("fact_bronze"), place.checkpoint("versions")
    for half in ("early", "NOT early"):
        land_json_arrays(documents.where(half).drop("early"), folder)
        bronze(spark, folder, declared, table, place.checkpoint("bronze"), versions=versions)
        newest = evolve(spark, table, versions, declared)
    rows = spark.table(table)
    filled = as_version(rows, newest).select("batch_id", "row_id", F.col("o_orderpriority").alias("filled_priority"))
    rescued = {f"rescued_{c}": F.get_json_object("rescued", f"$.o_{f}") for c, f in
               (("priority", "orderpriority"), ("price", "totalprice"), ("date", "orderdate"))}
    return rows.join(filled, ["batch_id", "row_id"]).select(
        "o_orderkey", (F.col("schema_version") == 1).alias("early"), "o_orderpriority", "filled_priority",
        *[c.alias(n) for n, c in rescued.items()], F.col("o_totalprice").cast("double").alias("o_totalprice"),
        "o_orderdate", "schema_version",
    )


@query("""
    SELECT l_orderkey AS order_key, l_linenumber AS line_number, s_suppkey AS supplier_key, s_nationkey AS nation_key,
           p_partkey AS part_key, p_brand AS brand, l_quantity AS quantity, cast(l_shipdate AS date) AS ship_date,
           s_suppkey % 3 = 0 AS came_late
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey
""")
def silver_replay_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines whose supplier came late, some with the key of another line: each arrives exactly once, however often late
    rows are looked for, out of the waiting room or by their identity in bronze."""
    place, folder = new_lakehouse(spark, "lines_late"), scratch(spark, "feed")
    land_json_lines(load(spark, sf_dir, "lineitem").withColumn("l_shipdate", F.to_date("l_shipdate")), folder)
    sources = {d.source.name: load(spark, sf_dir, d.source.name) for d in trade.LINES.dimensions}
    early = {**sources, "supplier": sources["supplier"].where("s_suppkey % 3 <> 0")}
    take_in(spark, trade.LINES, place, folder, land_dimensions(spark, trade.LINES, place, early), multi_line=False)
    tables = land_dimensions(spark, trade.LINES, place, sources)
    for _ in range(3):
        take_in(spark, trade.LINES, place, folder, tables, multi_line=False, late=True)
    room, columns = place.room(), with_identity(trade.LINES.silver)
    replay(spark.table(place.table("fact_bronze")), room, dims_of(trade.LINES.hops, tables), columns)
    streamed = spark.table(room.silver).select("batch_id", "row_id", F.lit(False).alias("came_late"))
    return room.facts(spark).join(streamed, ["batch_id", "row_id"], "left").select(
        *[F.col(c).cast("double").alias(c) if c == "quantity" else c for c in trade.LINES.silver],
        F.coalesce("came_late", F.lit(True)).alias("came_late"),
    )


def _grown(spark: SparkSession, sf_dir: str) -> tuple[Lakehouse, list[DataFrame], DataFrame]:
    """A lakehouse built from the orders before 1998 without one market segment, then refreshed with the later orders, then
    with that segment's customers; its fact rows after each, and the last report."""
    place, folder, sources = new_lakehouse(spark, "grown"), scratch(spark, "feed"), _sources(spark, sf_dir)
    early = {**sources, "customer": sources["customer"].filter("c_mktsegment <> 'MACHINERY'")}
    orders, facts = orders_by_day(spark, sf_dir), []
    land_json_arrays(orders.filter("o_orderdate < DATE'1998-01-01'"), folder)
    place, _ = rebuild(spark, trade.STAR, place, early, folder)
    facts.append(place.fact().rows(spark))
    land_json_arrays(orders.filter("coalesce(o_orderdate >= DATE'1998-01-01', true)"), folder)
    refresh(spark, trade.STAR, place, early, folder, late=True)
    facts.append(place.fact().rows(spark))
    report = refresh(spark, trade.STAR, place, sources, folder, late=True)
    return place, [*facts, place.fact().rows(spark)], report


@query(f"""
    WITH runs AS (
        SELECT s.*, CASE WHEN c_mktsegment = 'MACHINERY' THEN 3 WHEN order_date < DATE '1998-01-01' THEN 1 ELSE 2 END AS run
        FROM ({_SILVER_SQL}) s JOIN customer ON customer_key = c_custkey
    ),
    sizes AS (SELECT run, count(*) AS n FROM runs GROUP BY run)
    SELECT order_key, customer_key, nation_key, region_key, order_date, total_price, run,
           (SELECT cast(coalesce(sum(n), 0) AS bigint) FROM sizes WHERE sizes.run < runs.run) + 1 AS first_key,
           (SELECT cast(sum(n) AS bigint) FROM sizes WHERE sizes.run <= runs.run) AS last_key,
           1 AS rows_with_key
    FROM runs
""")
def fact_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact rows of three runs: the keys of each run follow those before without a gap, and no row's key ever changes.

    Which row of a run gets which of its keys is open.
    """
    _, facts, _ = _grown(spark, sf_dir)
    first, second, rows = facts
    known = first.select("fact_key", "order_key", F.lit(1).alias("run")).unionByName(
        second.join(first, "fact_key", "left_anti").select("fact_key", "order_key", F.lit(2).alias("run"))
    )
    # A row found again under its key has kept it.
    marked = rows.join(known, ["fact_key", "order_key"], "left").withColumn("run", F.coalesce("run", F.lit(3)))
    bounds = marked.groupBy("run").agg(F.min("fact_key").alias("first_key"), F.max("fact_key").alias("last_key"))
    shared = marked.groupBy("fact_key").agg(F.count("*").cast("int").alias("rows_with_key"))
    return _plain(marked.join(bounds, "run").join(shared, "fact_key").drop("fact_key"))


@query(_GOLD_SQL)
def gold_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold after three runs, each adding the sums of what silver gained."""
    _, _, report = _grown(spark, sf_dir)
    return report


@query("SELECT 20 AS rows_shown, 20 AS rows_genuine")
def stream_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which rows a preview shows is open; all of them must be rows of the feed."""
    feed = read_feed(spark, _feed(spark, sf_dir), trade.ORDERS.schema, max_files=1).drop("fields")
    shown = preview_stream(feed, 20).withColumn("o_orderkey", F.col("o_orderkey").cast("long"))
    orders = orders_by_day(spark, sf_dir).select("o_orderkey", F.lit(1).alias("genuine"))
    return shown.join(orders, "o_orderkey", "left").agg(
        F.count("*").cast("int").alias("rows_shown"),
        F.count("genuine").cast("int").alias("rows_genuine"),
    )
