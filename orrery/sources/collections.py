"""Document collections: each one a catalog table that is replaced whole when it is loaded."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from orrery.sources.files import read_json


def load_collections(
    spark: SparkSession,
    database: str,
    files: dict[str, str],
    schemas: dict[str, T.StructType] | None = None,
    multi_line: bool = True,
) -> dict[str, int]:
    """Replace each collection by the documents of its file or folder; documents per collection.

    Running it again gives the same collections. Where no schema is given it is inferred.
    """
    loaded = {}
    for name, path in files.items():
        documents = read_json(spark, path, (schemas or {}).get(name), multi_line)
        documents.write.mode("overwrite").saveAsTable(f"{database}.{name}")
        loaded[name] = spark.table(f"{database}.{name}").count()
    return loaded


def scan(spark: SparkSession, database: str, collection: str) -> DataFrame:
    return spark.table(f"{database}.{collection}")
