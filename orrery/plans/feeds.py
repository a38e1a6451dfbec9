"""Land a table as JSON files, the shape in which collections and feeds arrive: arrays, or a document per line."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FILE_BYTES = 32 << 20
MIN_FILES = 4
FILE_ROWS = 100_000


def land_json_arrays(df: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> None:
    """Add ``df`` to ``folder`` as files of about ``file_bytes`` that hold one array each.

    Rows are dealt evenly over the files, copies included. An array is gathered, and later read, by a single task,
    hence the bound on its size.
    """
    documents = df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))
    total = documents.agg(F.sum(F.octet_length("value") + 2)).first()[0] or 0
    files = max(MIN_FILES, -(-total // file_bytes))
    dealt = documents.withColumn("file", F.pmod(F.monotonically_increasing_id(), F.lit(files)))
    arrays = dealt.groupBy("file").agg(
        F.concat(F.lit("["), F.array_join(F.collect_list("value"), ","), F.lit("]")).alias("value")
    )
    arrays.select("value").write.mode("append").option("maxRecordsPerFile", 1).text(folder)


def land_json_lines(df: DataFrame, folder: str, file_rows: int = FILE_ROWS) -> None:
    """Add ``df`` to ``folder`` as compressed files of at most ``file_rows`` documents, one per line.

    A line repeats all names of its fields, so that even the fastest compression saves four fifths of the disk. One task reads a
    file as a whole, hence the bound on its rows.
    """
    fast = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
    df.write.mode("append").options(**fast, maxRecordsPerFile=file_rows).json(folder)
