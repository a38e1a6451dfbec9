"""A ledger of a feed's files: what lay in the folder at each look, held against the lineage of bronze."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.sinks.catalog import create_table, overwrite_partition, partition_values
from orrery.sources.files import list_files

ENTRIES = "path string, modified timestamp, length long, listed_ts timestamp, look long"


def note_files(spark: SparkSession, folder: str, ledger: str, pattern: str = "*") -> int:
    """List the files now below the folder as a new look of the ledger; its number. Contents are not read."""
    if not spark.catalog.tableExists(ledger):
        create_table(spark, ledger, spark.createDataFrame([], ENTRIES), partition_by=["look"])
    look = max(partition_values(spark, ledger, "look"), default=0) + 1
    listed = list_files(spark, folder, pattern).select(
        plain_path(F.col("path")).alias("path"), F.col("modificationTime").alias("modified"), "length",
        F.current_timestamp().alias("listed_ts"),
    )
    overwrite_partition(spark, listed, ledger, {"look": look})
    return look


def plain_path(path: Column) -> Column:
    """Listings and lineage write a path's scheme with one slash or three."""
    return F.regexp_replace(path, "^([a-zA-Z][a-zA-Z0-9+.-]*):/+", "$1:/")


def file_states(spark: SparkSession, ledger: str, bronze: DataFrame) -> DataFrame:
    """(path, state, n_rows, first_look, last_look) of every file ever listed or taken in.

    ``skipped``: there at the last look, and no row of it is in bronze. ``rewritten``: taken in, and its size or time is no longer
    what it was at the last look before that; what it holds now was not taken in. ``vanished``: no longer there. ``taken``:
    as it was. ``unlisted``: taken in but never listed. Rows are counted per file before anything is joined.
    """
    looks = spark.table(ledger)
    newest = max(partition_values(spark, ledger, "look"), default=0)
    taken = bronze.groupBy(plain_path(F.col("source_file")).alias("path")).agg(
        F.count("*").alias("n_rows"), F.min("ingest_ts").alias("since")
    )
    both = looks.join(taken, "path", "full_outer")
    content = F.struct("modified", "length")
    before = F.col("since").isNull() | (F.col("listed_ts") <= F.col("since"))
    files = both.groupBy("path").agg(
        F.min("look").alias("first_look"), F.max("look").alias("last_look"), F.max("n_rows").alias("n_rows"),
        # A file that was first listed after it had been taken in counts as it was then.
        F.coalesce(F.max_by(content, F.when(before, F.col("look"))), F.min_by(content, "look")).alias("then"),
        F.max_by(content, "look").alias("now"),
    )
    state = (
        F.when(F.col("last_look").isNull(), "unlisted").when(F.col("last_look") < newest, "vanished")
        .when(F.col("n_rows").isNull(), "skipped").when(F.col("then") != F.col("now"), "rewritten").otherwise("taken")
    )
    return files.select("path", state.alias("state"), F.coalesce("n_rows", F.lit(0)).alias("n_rows"), "first_look", "last_look")
