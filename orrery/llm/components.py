"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.session import scratch


def store(rows: DataFrame, purpose: str) -> DataFrame:
    """Write the rows to the shared folder and read them from there: lineage ends, lost executors cost nothing."""
    path = scratch(rows.sparkSession, purpose)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, label) for each id with a link; the label is the smallest id that can be reached.

    Each round takes the smallest label among the neighbours and then that label's own label, so labels travel
    far in few rounds. All steps are joins and grouped minima over stored tables; a node with very many links
    is a large key of a join, which the adaptive plan splits.
    """
    ends = store(
        links.select(F.col(a).alias("id"), F.col(b).alias("to"))
        .union(links.select(F.col(b).alias("id"), F.col(a).alias("to"))).where("id <> to").distinct(),
        "links",
    )
    labels = store(ends.groupBy("id").agg(F.least(F.col("id"), F.min("to")).alias("label")), "labels")
    while True:
        seen = ends.join(labels.select(F.col("id").alias("to"), "label"), "to").select("id", "label")
        low = seen.union(labels).groupBy("id").agg(F.min("label").alias("label"))
        low = store(low, "labels")
        jump = low.join(
            low.select(F.col("id").alias("label"), F.col("label").alias("next")), "label", "left"
        ).select("id", F.least("label", "next").alias("label"))
        new = store(jump, "labels")
        moved = new.join(labels.withColumnRenamed("label", "before"), "id").where("label <> before")
        if moved.isEmpty():
            return new
        labels = new
