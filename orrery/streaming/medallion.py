"""Raw JSON files to bronze, bronze joined to dimensions to silver, silver averaged to gold.

Each streaming table has its own checkpoint below the shared root. A run with
``available_now=True`` takes in what has arrived since the last run and ends; otherwise the query
keeps running. Either way every file and every bronze row is taken in exactly once.

Bronze writes each micro-batch as a partition of its own, which a repeated attempt replaces. A row is known by its
batch and its number there (``IDENTITY``) from then on, whatever its fields hold: keys that are null or come twice
are rows like any other.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from orrery.functions.casts import cast_fields, exact, from_text
from orrery.models.table import Band, Hop
from orrery.operators.gold import gold_avg_by_group
from orrery.operators.joins import Dim, flagged, star_join, unmatched
from orrery.session import append_log, read_log, stored
from orrery.sinks.catalog import (
    FORMAT, add_columns, create_table, overwrite_partition, overwrite_table, partition_values,
)
from orrery.sources.documents import as_text, current_version, left_over, note_new_fields, parse_documents, whole

#: What tells bronze rows apart, in bronze and in silver.
IDENTITY = ("batch_id", "row_id")


def read_feed(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    multi_line: bool = True,
    max_files: int | None = None,
    max_file_age: str = "36500d",
) -> DataFrame:
    """The JSON files of a folder as a stream; each file once, also if it is rewritten later.

    A file older than ``max_file_age``, counted back from the newest one seen, would be skipped, so by default
    none ages out: copies that keep their times and backfills are taken in. The driver then remembers
    the path of every file it has seen, some hundred bytes each.

    Every field of the schema comes as text, whatever its type, so that a wrong value is still there to be
    kept; ``typed`` casts them. ``fields`` holds all fields of the document, also those that the schema lacks, and
    ``malformed`` the text of what is not JSON at all. With ``multi_line`` a file is one array of documents and is
    parsed as a whole by one task; otherwise each line is a document.
    """
    reader = spark.readStream.format("text").option("wholetext", multi_line).option("maxFileAge", max_file_age)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    pieces = reader.load(folder).select("value", F.col("_metadata.file_path").alias("source_file"))
    documents = parse_documents(pieces, "value", multi_line)
    texts = [as_text(F.col("fields"), f.name).alias(f.name) for f in schema.fields]
    return documents.select(*texts, "malformed", "fields", "source_file")


def typed(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """Fields cast to their types, the whole document, and when and from which file it came.

    ``rescued`` holds the JSON of the fields that no column takes: values that do not fit their type
    exactly, and fields that the schema lacks; or the text of what is malformed.
    """
    rescued = F.coalesce("malformed", left_over(F.col("fields"), schema.names, F.col("__misfits")))
    return cast_fields(raw, schema, "__misfits").select(
        *schema.names, rescued.alias("rescued"), F.current_timestamp().alias("ingest_ts"), "source_file",
        whole(F.col("fields")).alias("document"),
    )


def append_stream(
    df: DataFrame,
    table: str,
    checkpoint: str,
    available_now: bool = True,
    format: str = FORMAT,
) -> StreamingQuery:
    """Append the stream to a catalog table. An ``available_now`` run has ended on return."""
    writer = (
        df.writeStream.format(format).outputMode("append").option("checkpointLocation", checkpoint)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    query = writer.toTable(table)
    if available_now:
        query.awaitTermination()
    return query


def each_batch(
    df: DataFrame, checkpoint: str, take: Callable[[DataFrame, int], None], available_now: bool = True
) -> StreamingQuery:
    """Hand each micro-batch to ``take`` with its number. A batch may be handed over again after a failure."""
    writer = df.writeStream.option("checkpointLocation", checkpoint).foreachBatch(take)
    if available_now:
        writer = writer.trigger(availableNow=True)
    query = writer.start()
    if available_now:
        query.awaitTermination()
    return query


def bronze(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    table: str,
    checkpoint: str,
    available_now: bool = True,
    multi_line: bool = True,
    max_files: int | None = None,
    versions: str | None = None,
) -> StreamingQuery:
    """Raw rows with their lineage, their identity and the whole document.

    ``versions`` is the place of a log of schemas, of which ``schema`` is the first: rows are typed by the newest one, and
    the table gets the columns that it adds. ``evolve`` adds versions to the log.
    """
    number = None
    if versions:
        version = current_version(spark, versions, schema)
        number, schema = version.number, version.schema
    raw = typed(read_feed(spark, folder, schema, multi_line, max_files), schema).select(
        "*", F.lit(number).cast("int").alias("schema_version")
    )
    like = spark.createDataFrame([], raw.schema).select(
        "*", F.lit(0).cast("long").alias("row_id"), F.lit(0).cast("long").alias("batch_id")
    )
    if not spark.catalog.tableExists(table):
        create_table(spark, table, like, partition_by=["batch_id"])
    add_columns(spark, table, [f for f in schema.fields if f.name not in spark.table(table).columns])

    def take(rows: DataFrame, batch_id: int) -> None:
        numbered = rows.withColumn("row_id", F.monotonically_increasing_id())
        overwrite_partition(spark, numbered, table, {"batch_id": batch_id})

    return each_batch(raw, checkpoint, take, available_now)


def evolve(spark: SparkSession, table: str, versions: str, schema: T.StructType) -> T.StructType:
    """Look through the bronze rows that came since the last look for fields that the schema lacks; the schema from now on.

    Only rows with something left over are read, and only batches not looked through yet.
    """
    version = current_version(spark, versions, schema)
    fresh = spark.table(table).where(F.col("batch_id") > version.through)
    through = fresh.agg(F.max("batch_id")).first()[0]
    if through is None:
        return version.schema
    odd = fresh.where((F.col("schema_version") == version.number) & F.col("rescued").isNotNull())
    return note_new_fields(odd, versions, version, through).schema


def as_version(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Bronze rows with the columns of a later schema filled from their documents, for rows typed by an earlier one."""

    def filled(field: T.StructField) -> Column:
        # A version's own rows have it all; a text that does not fit stays rescued in any version.
        text = F.try_variant_get("document", "$['" + field.name.replace("'", "\\'") + "']", "string")
        late = F.when(exact(text, field.dataType), from_text(text, field.dataType))
        held = F.col(field.name) if field.name in rows.columns else F.lit(None).cast(field.dataType)
        return F.coalesce(held, late).alias(field.name)

    return rows.select(*[filled(f) for f in schema.fields], *[c for c in rows.columns if c not in schema.names])


def silver(
    spark: SparkSession,
    bronze_table: str,
    dims: list[Dim],
    columns: dict[str, str],
    table: str,
    checkpoint: str,
    available_now: bool = True,
    max_files: int | None = None,
    waiting_table: str | None = None,
) -> StreamingQuery:
    """Bronze rows with all their dimension keys.

    ``max_files`` bounds a micro-batch, for a backlog too large to join at once. Rows that lack a dimension go to
    ``waiting_table``, from which ``release`` takes them later; both tables then have a partition per micro-batch (``part``),
    which a repeated attempt replaces. Without that table they are left out: see ``quarantine``.
    """
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    rows = reader.table(bronze_table)
    if waiting_table is None:
        return append_stream(silver_rows(rows, dims, columns), table, checkpoint, available_now)
    _silver_tables(spark, bronze_table, dims, columns, table, waiting_table)

    def take(batch: DataFrame, part: int) -> None:
        _split(spark, batch, dims, columns, (table, {"part": part}), (waiting_table, {"run": 0, "part": part}))

    # A micro-batch is handed over as it was read: columns that silver does not need are left out before.
    return each_batch(_needed(rows, dims, columns), checkpoint, take, available_now)


def silver_rows(rows: DataFrame, dims: list[Dim], columns: dict[str, str]) -> DataFrame:
    joined = star_join(rows, dims)
    return joined.select(*[F.col(source).alias(name) for name, source in columns.items()])


def _silver_tables(
    spark: SparkSession, bronze_table: str, dims: list[Dim], columns: dict[str, str], table: str, waiting_table: str
) -> None:
    rows = spark.table(bronze_table)
    part, run = (F.lit(0).cast("long").alias(c) for c in ("part", "run"))
    if not spark.catalog.tableExists(table):
        create_table(spark, table, silver_rows(rows, dims, columns).select("*", part), partition_by=["part"])
    if not spark.catalog.tableExists(waiting_table):
        create_table(spark, waiting_table, _needed(rows, dims, columns).select(
            "*", F.lit(None).cast("array<int>").alias("missing"), run, part
        ), partition_by=["run", "part"])


def _needed(rows: DataFrame, dims: list[Dim], columns: dict[str, str]) -> DataFrame:
    """The columns of bronze that the joins and silver read: all that a waiting row must keep."""
    read = {c for d in dims for c in (*d.on, *d.spread_by)} | set(columns.values()) | set(IDENTITY)
    return rows.select(*[c for c in rows.columns if c in read])


def _split(
    spark: SparkSession, rows: DataFrame, dims: list[Dim], columns: dict[str, str], complete: tuple[str, dict], waiting: tuple[str, dict]
) -> None:
    """Join once; rows with all dimensions go to one partition, the others to another with what they lack."""
    kept = _needed(rows, dims, columns)
    read = dict.fromkeys([*kept.columns, *columns.values(), "missing"])
    with stored(flagged(kept, dims).select(*read), "joined") as joined:
        found = joined.where(F.size("missing") == 0)
        overwrite_partition(spark, found.select(*[F.col(s).alias(n) for n, s in columns.items()]), *complete)
        lacking = joined.where(F.size("missing") > 0)
        if not lacking.isEmpty():
            overwrite_partition(spark, lacking.select(*kept.columns, "missing"), *waiting)


@dataclass(frozen=True)
class WaitingRoom:
    """Where rows wait for late dimensions: silver, the rows that completed it later, the rows that wait, the log of runs.

    Run r reads the rows that run r - 1 left and the parts that silver has put aside since; it writes those that
    are complete now as run r of ``late``, the others as run r of ``waiting``, and notes itself in the log at last. So
    nothing of a run counts before its note, and a repeated attempt replaces what the failed one wrote.
    """

    silver: str
    late: str
    waiting: str
    log: str

    def last_run(self, spark: SparkSession) -> tuple[int, int]:
        """The last run noted, and the last part of silver's that it took in."""
        return max([(e["run"], e["part"]) for e in read_log(spark, self.log)], default=(0, -1))

    def facts(self, spark: SparkSession) -> DataFrame:
        """All of silver: rows as streamed, and those that came late."""
        streamed = spark.table(self.silver).drop("part")
        if not spark.catalog.tableExists(self.late):
            return streamed
        run, _ = self.last_run(spark)
        return streamed.unionByName(spark.table(self.late).where(F.col("run") <= run).drop("run"))

    def marks(self, spark: SparkSession) -> tuple[int, int]:
        """How far silver has come: its last part, and the last run that completed late rows."""
        return max(partition_values(spark, self.silver, "part"), default=-1), self.last_run(spark)[0]

    def since(
        self, spark: SparkSession, start: tuple[int, int], stop: tuple[int, int], extra: dict[str, Column] | None = None
    ) -> DataFrame:
        """The rows that silver gained between two marks; only their partitions are read.

        ``extra`` adds columns about each row's file, and with them ``__late`` and ``__part`` that say which partition it is in.
        """

        def between(table: str, column: str, low: int, high: int, late: bool) -> DataFrame:
            rows = spark.table(table).where((F.col(column) > low) & (F.col(column) <= high))
            if extra:
                rows = rows.withColumns(extra).withColumns({"__late": F.lit(late), "__part": F.col(column)})
            return rows.drop(column)

        rows = between(self.silver, "part", start[0], stop[0], False)
        if stop[1] == start[1]:
            return rows
        return rows.unionByName(between(self.late, "run", start[1], stop[1], True))

    def newest(self, spark: SparkSession) -> int:
        """The last part that silver has put rows aside in, or that a run took in."""
        return max([self.last_run(spark)[1], *partition_values(spark, self.waiting, "part")])

    def waiting_rows(self, spark: SparkSession, until: int | None = None) -> DataFrame:
        """The rows that wait now (of parts ``until`` that one), with the positions of the dimensions they lack.

        Partitions that earlier runs are done with are not read.
        """
        run, part = self.last_run(spark)
        of_run = (F.col("run") == run) & (F.col("run") > 0)
        put_aside = (F.col("run") == 0) & (F.col("part") > part)
        if until is not None:
            put_aside &= F.col("part") <= until
        return spark.table(self.waiting).where(of_run | put_aside)


def release(spark: SparkSession, room: WaitingRoom, dims: list[Dim], columns: dict[str, str]) -> DataFrame:
    """Complete silver with waiting rows whose dimension has arrived; returns all of silver."""
    part = room.newest(spark)
    _run(spark, room, room.waiting_rows(spark, part).drop("run", "part", "missing"), part, dims, columns)
    return room.facts(spark)


def replay(rows: DataFrame, room: WaitingRoom, dims: list[Dim], columns: dict[str, str]) -> DataFrame:
    """Complete silver with those of the given bronze rows that it lacks, and let the others wait anew; all of silver.

    Rows are told by their identity, so that a repeat adds nothing and no two rows are taken for one another.
    This reads all of silver: it is for a waiting room that was lost, or never kept. Silver's stream must not run meanwhile.
    """
    spark = rows.sparkSession
    done = room.facts(spark).select(*[F.col(c).alias(f"__{c}") for c in IDENTITY])
    missed = rows.join(done, [rows[c] == done[f"__{c}"] for c in IDENTITY], "left_anti")
    _run(spark, room, missed, room.newest(spark), dims, columns)
    return room.facts(spark)


def _run(
    spark: SparkSession, room: WaitingRoom, rows: DataFrame, part: int, dims: list[Dim], columns: dict[str, str]
) -> None:
    if not spark.catalog.tableExists(room.late):
        like = spark.table(room.silver).drop("part").select("*", F.lit(0).cast("long").alias("run"))
        create_table(spark, room.late, like, partition_by=["run"])
    run = room.last_run(spark)[0] + 1
    _split(spark, rows, dims, columns, (room.late, {"run": run}), (room.waiting, {"run": run, "part": -1}))
    append_log(spark, room.log, {"run": run, "part": part})


def dims_of(hops: tuple[Hop, ...], tables: dict[str, DataFrame]) -> list[Dim]:
    return [Dim(tables[hop.dimension], hop.on, hop.keep) for hop in hops]


def with_identity(columns: dict[str, str]) -> dict[str, str]:
    """Silver's columns and what tells its rows apart."""
    return {**columns, **{c: c for c in IDENTITY}}


def quarantine(bronze_rows: DataFrame, dims: list[Dim]) -> DataFrame:
    """Bronze rows whose keys some dimension still lacks, with the position of that dimension."""
    return unmatched(bronze_rows, dims)


def gold_rows(fact: DataFrame, tables: dict[str, DataFrame], band: Band) -> DataFrame:
    return gold_avg_by_group(
        fact,
        tables[band.bridge],
        tables[band.dimension],
        (band.key, band.key, band.key),
        band.title,
        band.measures,
    )


def gold(fact: DataFrame, tables: dict[str, DataFrame], band: Band, table: str) -> DataFrame:
    """Recompute the gold table from all of silver; returns it in report order."""
    overwrite_table(gold_rows(fact, tables, band), table)
    return fact.sparkSession.table(table).orderBy(band.order_by, band.title)
