"""First rows of a table or of a stream."""

from __future__ import annotations

from threading import Event

from pyspark.sql import DataFrame

from orrery.session import scratch


def preview(df: DataFrame, n: int, order_by: list[str]) -> DataFrame:
    """The first ``n`` rows in order: each task keeps only its own first ``n``."""
    return df.orderBy(*order_by).limit(n)


def preview_stream(df: DataFrame, n: int = 20) -> DataFrame:
    """Some ``n`` rows of what a stream holds now.

    Micro-batches are taken one by one until ``n`` rows are there, then the stream is stopped: with a source that gives one
    file at a time (``maxFilesPerTrigger``) no more files are read than it takes.
    """
    spark, path, have, enough = df.sparkSession, scratch(df.sparkSession, "preview"), [0], Event()

    def take(rows: DataFrame, batch: int) -> None:
        if have[0] < n:
            part = f"{path}/rows/batch={batch}"
            rows.limit(n - have[0]).write.mode("overwrite").parquet(part)
            have[0] += rows.sparkSession.read.parquet(part).count()
        if have[0] >= n:
            enough.set()

    writer = df.writeStream.foreachBatch(take).option("checkpointLocation", f"{path}/checkpoint")
    query = writer.trigger(availableNow=True).start()
    while not enough.is_set() and not query.awaitTermination(1):
        pass
    query.stop()
    if not have[0]:
        return spark.createDataFrame([], df.schema)
    return spark.read.schema(df.schema).parquet(f"{path}/rows").select(*df.columns)
