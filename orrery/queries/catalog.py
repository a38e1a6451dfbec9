"""Catalog databases and tables."""

from __future__ import annotations

from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.models import trade
from orrery.operators.conform import conform
from orrery.plans.warehouse import land_dimensions
from orrery.queries.registry import load, new_lakehouse, query
from orrery.session import scratch
from orrery.sinks import catalog


def _n_rows(table: DataFrame, name: str = "n_rows") -> DataFrame:
    return table.agg(F.count("*").alias(name))


@query("""
    SELECT 'Comment' AS info_name, 'It''s the order warehouse' AS info_value,
           (SELECT count(*) FROM orders) AS n_rows
    UNION ALL
    SELECT 'Properties', '((contains_pii,true), (purpose,order reports))',
           (SELECT count(*) FROM orders)
""")
def create_database(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comment and properties as the catalog gives them back, and a table landed there."""
    database = f"warehouse_{uuid4().hex}"
    for _ in range(2):
        catalog.create_database(
            spark, database, scratch(spark, "warehouse"), "It's the order warehouse",
            {"contains_pii": "true", "purpose": "order reports"},
        )
    catalog.overwrite_table(load(spark, sf_dir, "orders"), f"{database}.orders")
    described = catalog.describe_database(spark, database)
    landed = spark.table(f"{database}.orders").count()
    return described.filter(F.col("info_name").isin("Comment", "Properties")).select(
        "info_name", "info_value", F.lit(landed).cast("long").alias("n_rows")
    )


@query("""
    SELECT count(*) AS rows_before, 0 AS databases_after FROM customer
""")
def drop_database(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The database goes with its tables; dropping it again does nothing."""
    place = new_lakehouse(spark, "dropped")
    catalog.overwrite_table(load(spark, sf_dir, "customer"), place.table("customer"))
    rows = spark.table(place.table("customer")).count()
    catalog.drop_database(spark, place.database)
    catalog.drop_database(spark, place.database)
    left = spark.sql(f"SHOW DATABASES LIKE '{place.database}'")
    return left.agg(
        F.lit(rows).cast("long").alias("rows_before"),
        F.count("*").cast("int").alias("databases_after"),
    )


@query("SELECT c_custkey, c_name FROM customer WHERE c_acctbal >= 0")
def ctas_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first definition stays although the second asks for other rows and columns."""
    place = new_lakehouse(spark, "ctas")
    customer = load(spark, sf_dir, "customer")
    table, location = place.table("dim_customer"), f"{place.root}/dim_customer"
    solvent = customer.filter("c_acctbal >= 0").select("c_custkey", "c_name")
    catalog.create_table_as(spark, table, solvent, location, "customers in credit")
    catalog.create_table_as(spark, table, customer, location)
    return spark.table(table)


@query("SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def overwrite_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and schema are replaced."""
    place = new_lakehouse(spark, "overwrite")
    table = place.table("dim_party")
    catalog.overwrite_table(load(spark, sf_dir, "customer"), table)
    catalog.overwrite_table(load(spark, sf_dir, "supplier"), table)
    return spark.table(table)


@query("""
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
           cast(o_orderdate AS date) AS o_orderdate, o_orderpriority
    FROM orders
""")
def insert_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two inserts into an empty typed table, the second with its columns in another order."""
    place = new_lakehouse(spark, "inserts")
    table = place.table("orders")
    orders = conform(load(spark, sf_dir, "orders"), trade.ORDERS)
    catalog.create_table(spark, table, orders)
    catalog.insert_rows(orders.filter("o_orderstatus = 'F'"), table)
    rest = orders.filter("NOT o_orderstatus <=> 'F'")
    catalog.insert_rows(rest.select(*reversed(rest.columns)), table)
    return spark.table(table).withColumn("o_totalprice", F.col("o_totalprice").cast("double"))


@query("""
    SELECT o_orderstatus, count(*) AS n_orders,
           cast(sum(cast(o_totalprice AS decimal(18, 2))) AS double) / count(*) AS avg_price
    FROM orders GROUP BY o_orderstatus
""")
def temp_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL over a named view."""
    view = f"orders_{uuid4().hex}"
    conform(load(spark, sf_dir, "orders"), trade.ORDERS).createOrReplaceTempView(view)
    return spark.sql(f"""
        SELECT o_orderstatus, count(*) AS n_orders,
               cast(sum(o_totalprice) AS double) / count(o_totalprice) AS avg_price
        FROM {view} GROUP BY o_orderstatus
    """)


@query("""
    SELECT 'dim_customer' AS table_name, count(*) AS n_rows FROM customer
    UNION ALL SELECT 'dim_nation', count(*) FROM nation
    UNION ALL SELECT 'dim_region', count(*) FROM region
    UNION ALL SELECT 'dim_supplier', count(*) FROM supplier
""")
def show_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dimensions the catalog lists after landing them, with their sizes."""
    place = new_lakehouse(spark, "listed")
    sources = {d.source.name: load(spark, sf_dir, d.source.name) for d in trade.STAR.dimensions}
    tables = land_dimensions(spark, trade.STAR, place, sources)
    before = spark.catalog.currentDatabase()
    catalog.use_database(spark, place.database)
    listed = catalog.show_tables(spark, place.database).filter("NOT isTemporary").select("tableName")
    catalog.use_database(spark, before)
    sizes = reduce(
        DataFrame.unionByName,
        [_n_rows(t).withColumn("table_name", F.lit(name)) for name, t in tables.items()],
    )
    return sizes.join(listed, sizes["table_name"] == listed["tableName"]).select(
        "table_name", "n_rows"
    )


@query("""
    SELECT col_name, data_type, (SELECT count(*) FROM orders) AS n_rows
    FROM (VALUES ('o_orderkey', 'bigint'), ('o_custkey', 'bigint'), ('o_orderstatus', 'string'),
                 ('o_totalprice', 'decimal(18,2)'), ('o_orderdate', 'date'),
                 ('o_orderpriority', 'string'), ('Provider', 'parquet'), ('Type', 'MANAGED')
         ) AS described (col_name, data_type)
""")
def describe_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns, provider and type of a landed table."""
    place = new_lakehouse(spark, "described")
    table = place.table("orders")
    orders = conform(load(spark, sf_dir, "orders"), trade.ORDERS)
    catalog.overwrite_table(orders, table)
    described = catalog.describe_table(spark, table)
    return described.filter(
        F.col("col_name").isin(*orders.columns, "Provider", "Type")
    ).select("col_name", "data_type", F.lit(spark.table(table).count()).cast("long").alias("n_rows"))
