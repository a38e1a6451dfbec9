"""Session defaults for tests and benchmarks, and scratch space that all executors share."""

from __future__ import annotations

import json
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_local_roots: dict[str, str] = {}
_owner: ContextVar[str | None] = ContextVar("owner", default=None)
_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cores: str = "8", app: str = "orrery", **conf: str) -> SparkSession:
    """A single-machine session; on a cluster the caller's own session is used instead."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder; elsewhere a machine-local folder
    would lose its data together with the machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    application = spark.sparkContext.applicationId
    if application not in _local_roots:
        _local_roots[application] = tempfile.mkdtemp(prefix="run-")
    return _local_roots[application]


def scratch(spark: SparkSession, purpose: str) -> str:
    """A path below the shared folder that no other call uses."""
    owner = _owner.get()
    below = f"{shared_root(spark)}/orrery-owned-{owner}" if owner else shared_root(spark)
    return f"{below}/orrery-{purpose}-{uuid4().hex}"


def scratch_table(spark: SparkSession, purpose: str) -> str:
    """The name of a table not used yet, in a database of this application's (or the owner's) scratch tables."""
    database = _scratch_database(spark, _owner.get())
    spark.sql(
        f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{shared_root(spark)}/{database}'"
    )
    return f"{database}.{purpose}_{uuid4().hex}"


def write_scratch(rows: DataFrame, purpose: str) -> str:
    """Write the rows as a scratch table: later reads do not compute them again."""
    table = scratch_table(rows.sparkSession, purpose)
    rows.write.format("parquet").saveAsTable(table)
    return table


@contextmanager
def stored(rows: DataFrame, purpose: str) -> Iterator[DataFrame]:
    """The rows, written once and read from there within this block; the files go at its end.

    Unlike persisted rows these take no memory, are there even if none of their partitions was read yet, and outlive their
    executor.
    """
    spark = rows.sparkSession
    path = scratch(spark, purpose)
    try:
        with freed_shuffles(spark):
            rows.write.option("compression", "zstd").parquet(path)
        yield spark.read.schema(rows.schema).parquet(path)
    finally:
        remove(spark, path, below=shared_root(spark))


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query run in this block go as soon as it has ended.

    Otherwise they stay until the driver happens to collect its garbage, and those of one step after another fill the disks.
    """
    before = spark.conf.get(_FREE_SHUFFLES, None)
    spark.conf.set(_FREE_SHUFFLES, True)
    try:
        yield
    finally:
        spark.conf.unset(_FREE_SHUFFLES) if before is None else spark.conf.set(_FREE_SHUFFLES, before)


@contextmanager
def owned_scratch() -> Iterator[str]:
    """Scratch tables and folders made in this block belong to the owner it yields, for ``release_scratch``."""
    owner = uuid4().hex
    token = _owner.set(owner)
    try:
        yield owner
    finally:
        _owner.reset(token)


def release_scratch(spark: SparkSession, owner: str | None = None) -> None:
    """Drop an owner's scratch tables and delete its folders, once the results that read them are stored elsewhere.

    Without an owner the tables that belong to none are dropped; those of owners stay.
    """
    spark.sql(f"DROP DATABASE IF EXISTS {_scratch_database(spark, owner)} CASCADE")
    if owner:
        remove(spark, f"{shared_root(spark)}/orrery-owned-{owner}", below=shared_root(spark))


def _scratch_database(spark: SparkSession, owner: str | None = None) -> str:
    application = "".join(c if c.isalnum() else "_" for c in spark.sparkContext.applicationId)
    return f"orrery_scratch_{application}" + (f"_{owner}" if owner else "")


def append_log(spark: SparkSession, log: str, entry: dict) -> None:
    """Add an entry to a small log on shared storage: one file, which readers see as a whole or not at all."""
    line = spark.range(1).select(F.lit(json.dumps(entry)).alias("value"))
    line.coalesce(1).write.mode("append").text(log)


def read_log(spark: SparkSession, log: str) -> list[dict]:
    """The entries of a log in no particular order; none if it was never written."""
    try:
        lines = spark.read.text(log).collect()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return [json.loads(line.value) for line in lines]


def remove(spark: SparkSession, path: str, below: str) -> bool:
    """Delete a folder that lies below another one, and nothing else; whether it was there."""
    if not path.startswith(below.rstrip("/") + "/") or ".." in path.split("/"):
        raise ValueError(f"{path} does not lie below {below}")
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)
