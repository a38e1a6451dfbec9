"""Audits, and deletes and key changes carried along references."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.models import trade
from orrery.models.table import LONG, Field, Reference, Table, money
from orrery.operators import audits, cascade
from orrery.operators.closure import delete_closure
from orrery.plans.landing import LandingRefused, land_audited
from orrery.queries.registry import load, new_lakehouse, query


@query("""
    SELECT 'required:' || f.name AS rule, cast(doc_id AS varchar) AS key,
           cast(NULL AS varchar) AS value
    FROM documents LEFT JOIN labels USING (doc_id),
         (VALUES ('quality'), ('toxic'), ('text')) AS f (name)
    WHERE CASE f.name WHEN 'quality' THEN quality IS NULL WHEN 'toxic' THEN toxic IS NULL
                      ELSE text IS NULL END
""")
def not_null_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = load(spark, sf_dir, "documents").join(
        load(spark, sf_dir, "labels"), "doc_id", "left"
    )
    return audits.audit_required(labelled, ("doc_id",), ["quality", "toxic", "text"])


@query("""
    SELECT 'length:text' AS rule, cast(doc_id AS varchar) AS key,
           cast(length(text) AS varchar) AS value
    FROM documents WHERE length(text) > 1000
    UNION ALL
    SELECT 'length:source', cast(doc_id AS varchar), cast(length(source) AS varchar)
    FROM documents WHERE length(source) > 9
""")
def length_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = load(spark, sf_dir, "documents")
    return audits.audit_lengths(documents, ("doc_id",), {"text": 1000, "source": 9})


@query("""
    SELECT 'type:o_totalprice' AS rule, cast(o_orderkey AS varchar) AS key,
           cast(cast(o_totalprice AS decimal(18, 2)) AS varchar) AS value
    FROM orders WHERE cast(o_totalprice AS decimal(18, 2)) > 99999.99
""")
def type_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices arriving as text that a DECIMAL(7,2) cannot hold."""
    text = load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.col("o_totalprice").cast(money(18)).cast("string").alias("o_totalprice"),
    )
    declared = Table("orders", ("o_orderkey",), (
        Field("o_orderkey", LONG), Field("o_totalprice", money(7)),
    ))
    return audits.audit_types(text, declared)


@query("""
    SELECT l_orderkey, l_linenumber, count(*) AS n_rows
    FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
""")
def pk_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audits.pk_duplicates(load(spark, sf_dir, "lineitem"), list(trade.LINEITEM.key))


@query("""
    SELECT doc_id, count(*) AS n_rows FROM documents
    WHERE doc_id NOT IN (SELECT doc_id FROM labels) GROUP BY doc_id
""")
def fk_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audits.fk_orphans(
        load(spark, sf_dir, "documents"), ["doc_id"], load(spark, sf_dir, "labels"), ["doc_id"]
    )


@query("""
    SELECT c.conv_id, c.turn + 1 AS next_turn, count(*) AS n_rows
    FROM conversations c
    WHERE NOT EXISTS (
        SELECT 1 FROM conversations n WHERE n.conv_id = c.conv_id AND n.turn = c.turn + 1
    )
    GROUP BY ALL
""")
def fk_orphans_self(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reference of a table to itself on two columns: turns whose next turn does not exist."""
    turns = load(spark, sf_dir, "conversations").select("conv_id", "turn")
    following = turns.select("conv_id", (F.col("turn") + 1).alias("next_turn"))
    return audits.fk_orphans(following, ["conv_id", "next_turn"], turns, ["conv_id", "turn"])


@query("""
    SELECT 'nation.n_regionkey' AS reference, count(*) AS orphans
    FROM nation WHERE n_regionkey NOT IN (SELECT r_regionkey FROM region)
    UNION ALL SELECT 'customer.c_nationkey', count(*)
    FROM customer WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation)
    UNION ALL SELECT 'supplier.s_nationkey', count(*)
    FROM supplier WHERE s_nationkey NOT IN (SELECT n_nationkey FROM nation)
    UNION ALL SELECT 'orders.o_custkey', count(*)
    FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)
    UNION ALL SELECT 'lineitem.l_orderkey', count(*)
    FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
    UNION ALL SELECT 'lineitem.l_partkey', count(*)
    FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part)
    UNION ALL SELECT 'lineitem.l_suppkey', count(*)
    FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier)
""")
def fk_audit_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without a parent for every reference of the model."""
    tables = _tables(spark, sf_dir)
    counted = [
        audits.fk_orphans(
            tables[r.child], list(r.child_key), tables[r.parent], list(r.parent_key)
        ).agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("orphans"))
        .select(F.lit(f"{r.child}.{'/'.join(r.child_key)}").alias("reference"), "orphans")
        for r in trade.REFERENCES
    ]
    return reduce(DataFrame.unionByName, counted)


def _tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: load(spark, sf_dir, name) for name in trade.TABLES}


_FAULTY_SQL = """
    WITH faulty AS (
        SELECT c_custkey, CASE WHEN c_custkey % 53 = 0 THEN c_name || ' of a much longer name' ELSE c_name END AS c_name,
               CASE WHEN c_custkey % 50 = 0 THEN NULL WHEN c_custkey % 51 = 0 THEN 99 ELSE c_nationkey END AS c_nationkey,
               cast(c_acctbal AS decimal(18, 3))
               + CASE WHEN c_custkey % 57 = 0 THEN 0.001 ELSE 0 END AS c_acctbal
        FROM customer
    ),
    twice AS (SELECT * FROM faulty UNION ALL SELECT * FROM faulty WHERE c_custkey % 59 = 0)
"""


@query(f"""
    {_FAULTY_SQL}
    SELECT 'dim_customer' AS table_name, 'required:c_nationkey' AS rule, cast(c_custkey AS varchar) AS key,
           cast(NULL AS varchar) AS value
    FROM twice WHERE c_nationkey IS NULL
    UNION ALL SELECT 'dim_customer', 'length:c_name', cast(c_custkey AS varchar), cast(length(c_name) AS varchar)
    FROM twice WHERE length(c_name) > 25
    UNION ALL SELECT 'dim_customer', 'type:c_acctbal', cast(c_custkey AS varchar), cast(c_acctbal AS varchar)
    FROM twice WHERE c_custkey % 57 = 0
    UNION ALL SELECT 'dim_customer', 'key:customer_key', cast(c_custkey AS varchar), cast(count(*) AS varchar)
    FROM twice GROUP BY c_custkey HAVING count(*) > 1
    UNION ALL SELECT 'dim_customer', 'reference:nation_key', '99', cast(count(*) AS varchar)
    FROM twice WHERE c_nationkey = 99 HAVING count(*) > 0
""")
def land_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything wrong with customers that are landed with faults. A load with more repeated keys than allowed is refused
    before, and leaves the sound customers of the load before it in place."""
    place, key = new_lakehouse(spark, "landing"), F.col("c_custkey")
    sources = {d.source.name: load(spark, sf_dir, d.source.name) for d in trade.STAR.dimensions}
    land_audited(spark, trade.STAR, place.landing(), sources)
    sound = sources["customer"]
    odd = F.when(key % 57 == 0, F.lit("0.001").cast("decimal(18,3)")).otherwise(F.lit(0).cast("decimal(18,3)"))
    faulty = sound.withColumns({
        "c_name": F.when(key % 53 == 0, F.concat("c_name", F.lit(" of a much longer name"))).otherwise(F.col("c_name")),
        "c_nationkey": F.when(key % 51 == 0, F.lit(99)).otherwise(F.col("c_nationkey")),
        "c_acctbal": (F.col("c_acctbal").cast("decimal(18,3)") + odd).cast("decimal(18,3)"),
    }).withColumn("c_nationkey", F.when(key % 50 != 0, F.col("c_nationkey")))
    sources["customer"] = faulty.unionByName(faulty.where(key % 59 == 0))
    try:
        land_audited(spark, trade.STAR, place.landing({"key": 0}), sources)
    except LandingRefused as refused:
        kept = spark.table(place.table("dim_customer")).count()
        if kept != sound.count() or not refused.counts:
            raise
    land_audited(spark, trade.STAR, place.landing({"key": sound.count()}), sources)
    return place.landing().violations(spark).where("load = 3").drop("load")


_DELETED_SQL = """
    WITH n AS (SELECT * FROM nation WHERE n_name <> 'NATION_3'),
         c AS (SELECT * FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM n)),
         s AS (SELECT * FROM supplier WHERE s_nationkey IN (SELECT n_nationkey FROM n)),
         o AS (SELECT * FROM orders WHERE o_custkey IN (SELECT c_custkey FROM c)),
         l AS (SELECT * FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM o)
                                        AND l_suppkey IN (SELECT s_suppkey FROM s))
"""


@query(f"{_DELETED_SQL} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM l")
def cascade_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items left after one nation goes, with its customers, their orders, its suppliers."""
    left, _ = delete_closure(
        _tables(spark, sf_dir), trade.REFERENCES, "nation", "n_name = 'NATION_3'"
    )
    return left["lineitem"].select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query(f"""
    {_DELETED_SQL}
    SELECT 'nation' AS table_name, count(*) AS n_rows FROM n
    UNION ALL SELECT 'customer', count(*) FROM c
    UNION ALL SELECT 'supplier', count(*) FROM s
    UNION ALL SELECT 'orders', count(*) FROM o
    UNION ALL SELECT 'lineitem', count(*) FROM l
""")
def cascade_delete_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows left in every table the delete reaches."""
    left, _ = delete_closure(
        _tables(spark, sf_dir), trade.REFERENCES, "nation", "n_name = 'NATION_3'"
    )
    sizes = [
        rows.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, rows in left.items()
    ]
    return reduce(DataFrame.unionByName, sizes)


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
    WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size < 5)
""")
def cascade_restrict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reference that does not cascade: the line items that keep small parts from going."""
    references = tuple(
        replace(r, cascade=False) if r.parent == "part" else r for r in trade.REFERENCES
    )
    _, blocked = delete_closure(
        _tables(spark, sf_dir), references, "part", "p_size < 5"
    )
    (rows,) = blocked.values()
    return rows.select("l_orderkey", "l_linenumber", "l_partkey")


@query("""
    SELECT 'nation' AS table_name, cast(n_nationkey AS bigint) AS row_key,
           CASE WHEN n_regionkey = 1 THEN n_nationkey + 100 ELSE n_nationkey END AS nation_key
    FROM nation
    UNION ALL
    SELECT 'customer', c_custkey,
           CASE WHEN n_regionkey = 1 THEN n_nationkey + 100 ELSE n_nationkey END
    FROM customer JOIN nation ON c_nationkey = n_nationkey
    UNION ALL
    SELECT 'supplier', s_suppkey,
           CASE WHEN n_regionkey = 1 THEN n_nationkey + 100 ELSE n_nationkey END
    FROM supplier JOIN nation ON s_nationkey = n_nationkey
""")
def cascade_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New keys for the nations of one region, carried into customer and supplier."""
    tables = _tables(spark, sf_dir)
    tables["nation"] = tables["nation"].withColumn("old_key", F.col("n_nationkey").cast("long"))
    key_map = load(spark, sf_dir, "nation").filter("n_regionkey = 1").select(
        F.col("n_nationkey").alias("old"), (F.col("n_nationkey") + 100).alias("new")
    )
    changed, _ = cascade.cascade_update(
        tables, trade.REFERENCES, "nation", "n_nationkey", key_map
    )
    return reduce(DataFrame.unionByName, [
        changed[name].select(
            F.lit(name).alias("table_name"), F.col(row).alias("row_key"),
            F.col(nation).alias("nation_key"),
        )
        for name, row, nation in (
            ("nation", "old_key", "n_nationkey"),
            ("customer", "c_custkey", "c_nationkey"),
            ("supplier", "s_suppkey", "s_nationkey"),
        )
    ])


_CHAIN_SQL = """
    WITH RECURSIVE gone(conv_id, turn) AS (
        SELECT conv_id, turn FROM conversations WHERE conv_id % 5 = 0 AND turn = 2
        UNION
        SELECT c.conv_id, c.turn FROM conversations c JOIN gone g ON c.conv_id = g.conv_id AND c.turn = g.turn + 1
    )
"""


@query(f"""
    {_CHAIN_SQL}
    SELECT conv_id, turn FROM conversations c
    WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.conv_id = c.conv_id AND g.turn = c.turn)
""")
def cascade_delete_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of conversations left when a turn goes with all that follow it: a table that refers to itself, to any depth."""
    turns = load(spark, sf_dir, "conversations").select("conv_id", "turn", (F.col("turn") - 1).alias("before"))
    reference = Reference("turns", ("conv_id", "before"), "turns", ("conv_id", "turn"))
    left, _ = delete_closure({"turns": turns}, (reference,), "turns", "conv_id % 5 = 0 AND turn = 2")
    return left["turns"].select("conv_id", "turn")


@query("""
    SELECT c.conv_id, c.turn FROM conversations c
    WHERE c.conv_id % 5 = 0 AND c.turn = 3
      AND EXISTS (SELECT 1 FROM conversations b WHERE b.conv_id = c.conv_id AND b.turn = 2)
""")
def cascade_restrict_self(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same reference where it blocks: the turns that keep those before them from going."""
    turns = load(spark, sf_dir, "conversations").select("conv_id", "turn", (F.col("turn") - 1).alias("before"))
    reference = Reference("turns", ("conv_id", "before"), "turns", ("conv_id", "turn"), cascade=False)
    _, blocked = delete_closure({"turns": turns}, (reference,), "turns", "conv_id % 5 = 0 AND turn = 2")
    return blocked[reference].select("conv_id", "turn")
