"""Document collections: load, scan, find."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.models import trade
from orrery.operators.find import find
from orrery.plans.feeds import land_json_arrays
from orrery.queries.registry import load, new_lakehouse, query
from orrery.session import scratch
from orrery.sources.collections import load_collections, scan


def _collection(spark: SparkSession, sf_dir: str, name: str, **schemas) -> DataFrame:
    """The table written as JSON array files, loaded as a collection and scanned."""
    source = load(spark, sf_dir, name)
    folder = scratch(spark, "collection")
    land_json_arrays(source, folder)
    place = new_lakehouse(spark, "collections")
    load_collections(spark, place.database, {name: folder}, schemas or {name: source.schema})
    return scan(spark, place.database, name)


@query("""
    SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment,
           (SELECT count(*) FROM customer) AS documents_loaded
    FROM customer
""")
def json_collection_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loading twice replaces the collection."""
    folder = scratch(spark, "collection")
    land_json_arrays(load(spark, sf_dir, "customer"), folder)
    place = new_lakehouse(spark, "collections")
    schemas = {"customer": trade.CUSTOMER.schema}
    load_collections(spark, place.database, {"customer": folder}, schemas)
    loaded = load_collections(spark, place.database, {"customer": folder}, schemas)
    return scan(spark, place.database, "customer").select(
        "c_custkey", "c_name", "c_nationkey", F.col("c_acctbal").cast("double").alias("c_acctbal"),
        "c_mktsegment", F.lit(loaded["customer"]).cast("long").alias("documents_loaded"),
    )


@query("""
    SELECT doc_id, lang, source, n_chars, length(text) AS text_length, md5(text) AS text_md5
    FROM documents
""")
def doc_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents through JSON and back, compared by their digest."""
    return _collection(spark, sf_dir, "documents").select(
        "doc_id", "lang", "source", "n_chars",
        F.length("text").cast("long").alias("text_length"), F.md5("text").alias("text_md5"),
    )


@query("""
    SELECT event_id, user_id, event_type, value FROM events
    WHERE event_type IN ('click', 'error') AND user_id >= 10
      AND (value > 20 OR user_id < 40) AND props <> '{"k": 69}'
""")
def doc_find_filter_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(
        load(spark, sf_dir, "events"),
        {
            "event_type": {"$in": ["click", "error"]},
            "user_id": {"$gte": 10},
            "$or": [{"value": {"$gt": 20}}, {"user_id": {"$lt": 40}}],
            "props": {"$ne": '{"k": 69}'},
            "archived": {"$exists": False},
        },
        {"event_id": 1, "user_id": 1, "event_type": 1, "value": 1},
    )


@query("""
    SELECT event_id, ts, user_id, event_type, value FROM events
    WHERE event_type = 'click' AND value > 5
    ORDER BY value DESC, event_id
""")
def doc_find_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(
        load(spark, sf_dir, "events"),
        {"event_type": "click", "value": {"$gt": 5}},
        {"props": 0},
        [("value", -1), ("event_id", 1)],
    )


@query("""
    SELECT d.doc_id, d.lang, l.quality
    FROM documents d LEFT JOIN labels l USING (doc_id)
    WHERE l.quality IS DISTINCT FROM 1 AND (d.lang IS NULL OR d.lang NOT IN ('en', 'de'))
""")
def doc_find_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``$ne`` and ``$nin`` match documents that lack the field."""
    documents = load(spark, sf_dir, "documents").join(
        load(spark, sf_dir, "labels"), "doc_id", "left"
    )
    return find(
        documents,
        {"quality": {"$ne": 1}, "lang": {"$nin": ["en", "de"]}},
        ["doc_id", "lang", "quality"],
    )
