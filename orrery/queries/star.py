"""Star joins, key renaming, surrogate keys, fact construction, gold averages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.models import trade
from orrery.operators import gold
from orrery.operators.conform import conform, dimension
from orrery.operators.joins import Dim, star_join
from orrery.operators.keys import assign_keys
from orrery.operators.preview import preview
from orrery.plans.warehouse import build_fact, keyed_dimension
from orrery.queries.registry import exact_avg, load, orders_by_day, query


@query(f"""
    SELECT n_name, {exact_avg('s_acctbal')} AS avg_supplier_balance,
           {exact_avg('c_acctbal')} AS avg_customer_balance
    FROM customer
    JOIN supplier ON c_nationkey = s_nationkey
    JOIN nation ON s_nationkey = n_nationkey
    GROUP BY n_name
    ORDER BY avg_supplier_balance, n_name
""")
def gold_avg_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    averages = gold.gold_avg_by_group(
        conform(load(spark, sf_dir, "customer"), trade.CUSTOMER),
        conform(load(spark, sf_dir, "supplier"), trade.SUPPLIER),
        load(spark, sf_dir, "nation"),
        ("c_nationkey", "s_nationkey", "n_nationkey"),
        "n_name",
        {
            "avg_supplier_balance": ("bridge", "s_acctbal"),
            "avg_customer_balance": ("fact", "c_acctbal"),
        },
    )
    return averages.orderBy("avg_supplier_balance", "n_name")


@query(f"""
    SELECT p_type, {exact_avg('p_retailprice')} AS avg_retail_price,
           {exact_avg('f.l_extendedprice')} AS avg_line_price,
           {exact_avg('b.l_quantity')} AS avg_quantity
    FROM lineitem f
    JOIN lineitem b ON f.l_partkey = b.l_partkey
    JOIN part ON b.l_partkey = p_partkey
    GROUP BY p_type
    ORDER BY avg_retail_price, p_type
""")
def gold_avg_by_shared_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many keys share one title, so each key weighs as much as its fan-out."""
    lines = conform(load(spark, sf_dir, "lineitem"), trade.LINEITEM)
    averages = gold.gold_avg_by_group(
        lines,
        lines,
        conform(load(spark, sf_dir, "part"), trade.PART),
        ("l_partkey", "l_partkey", "p_partkey"),
        "p_type",
        {
            "avg_retail_price": ("dim", "p_retailprice"),
            "avg_line_price": ("fact", "l_extendedprice"),
            "avg_quantity": ("bridge", "l_quantity"),
        },
    )
    return averages.orderBy("avg_retail_price", "p_type")


_STAR_SQL = """
    SELECT o_orderkey AS order_key, c_custkey AS customer_key, n_nationkey AS nation_key,
           r_regionkey AS region_key, cast(o_orderdate AS date) AS order_date,
           o_totalprice AS total_price
    FROM orders
    JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey
"""


def _dims(spark: SparkSession, sf_dir: str, salts: int = 1) -> list[Dim]:
    """Customer → nation → region; ``salts`` applies to customer, the one that grows."""
    return [
        Dim(
            load(spark, sf_dir, "customer"), {"o_custkey": "c_custkey"},
            {"customer_key": "c_custkey", "customer_nation": "c_nationkey"},
            salts, ("o_orderkey",),
        ),
        Dim(
            load(spark, sf_dir, "nation"), {"customer_nation": "n_nationkey"},
            {"nation_key": "n_nationkey", "nation_region": "n_regionkey"},
        ),
        Dim(
            load(spark, sf_dir, "region"), {"nation_region": "r_regionkey"},
            {"region_key": "r_regionkey"},
        ),
    ]


def _star_rows(spark: SparkSession, sf_dir: str, salts: int) -> DataFrame:
    joined = star_join(orders_by_day(spark, sf_dir), _dims(spark, sf_dir, salts))
    return joined.select(
        F.col("o_orderkey").alias("order_key"), "customer_key", "nation_key", "region_key",
        F.col("o_orderdate").alias("order_date"), F.col("o_totalprice").alias("total_price"),
    )


@query(_STAR_SQL)
def silver_star_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _star_rows(spark, sf_dir, salts=1)


@query(_STAR_SQL)
def silver_star_join_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows with the orders of a hot customer spread over 16 partitions."""
    return _star_rows(spark, sf_dir, salts=16)


@query("""
    SELECT c_custkey AS customer_key, c_name, c_nationkey AS nation_key, c_acctbal, c_mktsegment
    FROM customer
""")
def conform_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = trade.STAR.dimensions[0]
    renamed = dimension(load(spark, sf_dir, spec.source.name), spec)
    return renamed.withColumn("c_acctbal", F.col("c_acctbal").cast("double"))


@query("""
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
           l_tax, l_returnflag, l_linestatus, cast(l_shipdate AS date) AS l_shipdate,
           'decimal(18,2)' AS price_type, 'date' AS shipdate_type
    FROM lineitem
""")
def conform_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = conform(load(spark, sf_dir, "lineitem"), trade.LINEITEM)
    decimals = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    return typed.withColumns({
        "price_type": F.typeof("l_extendedprice"),
        "shipdate_type": F.typeof("l_shipdate"),
        **{name: F.col(name).cast("double") for name in decimals},
    })


@query("""
    SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) AS customer_key FROM customer
""")
def surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_keys(load(spark, sf_dir, "customer"), ["c_custkey"], "customer_key")


@query("""
    WITH known AS (
        SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS order_key
        FROM orders WHERE o_orderstatus = 'F'
    )
    SELECT * FROM known
    UNION ALL
    SELECT o_orderkey,
           (SELECT max(order_key) FROM known) + row_number() OVER (ORDER BY o_orderkey)
    FROM orders WHERE o_orderstatus <> 'F'
""")
def surrogate_keys_extend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finished orders are keyed first; a later run over all orders continues from there."""
    orders = load(spark, sf_dir, "orders")
    known = assign_keys(orders.filter("o_orderstatus = 'F'"), ["o_orderkey"], "order_key")
    return assign_keys(orders, ["o_orderkey"], "order_key", existing=known)


@query("""
    WITH sources AS (
        SELECT lang, source, row_number() OVER (ORDER BY lang, source) AS source_key
        FROM (SELECT DISTINCT lang, source FROM documents)
    )
    SELECT doc_id, source_key FROM documents JOIN sources USING (lang, source)
""")
def surrogate_keys_shared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dimension drawn from a repeated attribute pair, and every document's key in it."""
    documents = load(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    keys = assign_keys(documents, ["lang", "source"], "source_key")
    return documents.join(keys, ["lang", "source"]).select("doc_id", "source_key")


@query("""
    WITH c AS (
        SELECT *, row_number() OVER (ORDER BY c_custkey) AS customer_key FROM customer
    ), n AS (
        SELECT *, row_number() OVER (ORDER BY n_nationkey) AS nation_key FROM nation
    ), r AS (
        SELECT *, row_number() OVER (ORDER BY r_regionkey) AS region_key FROM region
    )
    SELECT row_number() OVER (ORDER BY o_orderkey) AS fact_key, o_orderkey AS order_key,
           customer_key, nation_key, region_key, cast(o_orderdate AS date) AS order_date, o_totalprice AS total_price
    FROM orders
    JOIN c ON o_custkey = c_custkey
    JOIN n ON c_nationkey = n_nationkey
    JOIN r ON n_regionkey = r_regionkey
""")
def fact_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = keyed_dimension(load(spark, sf_dir, "customer"), ["c_custkey"], "customer_key")
    nation = keyed_dimension(load(spark, sf_dir, "nation"), ["n_nationkey"], "nation_key")
    region = keyed_dimension(load(spark, sf_dir, "region"), ["r_regionkey"], "region_key")
    dims = [
        Dim(customer, {"o_custkey": "c_custkey"},
            {"customer_key": "customer_key", "c_nationkey": "c_nationkey"}),
        Dim(nation, {"c_nationkey": "n_nationkey"},
            {"nation_key": "nation_key", "n_regionkey": "n_regionkey"}),
        Dim(region, {"n_regionkey": "r_regionkey"}, {"region_key": "region_key"}),
    ]
    return build_fact(orders_by_day(spark, sf_dir), dims, "fact_key", {
        "order_key": "o_orderkey",
        "customer_key": "customer_key",
        "nation_key": "nation_key",
        "region_key": "region_key",
        "order_date": "o_orderdate",
        "total_price": "o_totalprice",
    }, order_by=["order_key"])


@query("""
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders
    ORDER BY o_totalprice NULLS FIRST, o_orderkey LIMIT 20
""")
def preview_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return preview(orders, 20, ["o_totalprice", "o_orderkey"])
