"""What is kept up by adding only the rows that silver gained: the fact table and gold's sums.

Each keeps a log of its runs. A run is reserved first: which parts of silver it takes, and for the fact table which
keys. It then writes one partition and is noted as done. A run that was reserved and not done is taken up again with the
same reservation and replaces what it wrote, so keys have no gaps and no row counts twice.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orrery.models.table import Band
from orrery.operators.gold import averages, per_key, sum_states
from orrery.session import append_log, read_log
from orrery.sinks.catalog import create_table, overwrite_partition
from orrery.streaming.medallion import IDENTITY, WaitingRoom


@dataclass(frozen=True)
class Run:
    """One run: the marks of silver (last part, last late run) it reaches from and to, and where its keys begin."""

    number: int
    start: tuple[int, int]
    stop: tuple[int, int]
    first: int = 1
    rows: int = 0


class Runs:
    """A log of runs, each noted when it is reserved and when it is done."""

    def __init__(self, spark: SparkSession, log: str) -> None:
        self.spark, self.log = spark, log
        noted = read_log(spark, log)
        self.done = max((e["run"] for e in noted if e["done"]), default=0)
        self.reserved = {
            e["run"]: Run(e["run"], tuple(e["start"]), tuple(e["stop"]), e["first"], e["rows"]) for e in noted if not e["done"]
        }

    def last(self) -> Run:
        return self.reserved.get(self.done, Run(0, (-1, 0), (-1, 0)))

    def open(self) -> Run | None:
        """A run that was reserved and not done."""
        return self.reserved.get(self.done + 1)

    def reserve(self, run: Run) -> None:
        append_log(self.spark, self.log, {
            "run": run.number, "done": False, "start": run.start, "stop": run.stop, "first": run.first, "rows": run.rows,
        })
        self.reserved[run.number] = run

    def finish(self, run: Run) -> None:
        append_log(self.spark, self.log, {"run": run.number, "done": True})
        self.done = run.number


@dataclass(frozen=True)
class Facts:
    """The fact table of a star: silver's rows under a gapless generated key, which a row keeps for good."""

    room: WaitingRoom
    table: str
    log: str
    key: str = "fact_key"

    def rows(self, spark: SparkSession) -> DataFrame:
        done = Runs(spark, self.log).done
        return spark.table(self.table).where(F.col("run") <= done).drop("run")

    def extend(self, spark: SparkSession) -> DataFrame:
        """Append what silver gained since the last run, numbered from the highest key on; the rows of this run.

        Silver's files are stored already and never change, so a row's number follows from its file, the sizes of
        the files before it and its place there: nothing is sorted or written besides the new fact rows.
        """
        runs = Runs(spark, self.log)
        columns = [c for c in spark.table(self.room.silver).columns if c not in (*IDENTITY, "part")]
        if not spark.catalog.tableExists(self.table):
            like = spark.table(self.room.silver).select(F.lit(0).cast("long").alias(self.key), *columns, F.lit(0).cast("long").alias("run"))
            create_table(spark, self.table, like, partition_by=["run"])
        run = runs.open()
        if run is None:
            last = runs.last()
            run = Run(last.number + 1, last.stop, self.room.marks(spark), last.first + last.rows)
            placed = self._placed(spark, run)
            n = placed.count()
            if not n:
                return spark.table(self.table).where("false").drop("run")
            run = Run(run.number, run.start, run.stop, run.first, n)
            runs.reserve(run)
        placed = self._placed(spark, run)
        order = Window.orderBy("__late", "__part", "__file").rowsBetween(Window.unboundedPreceding, -1)
        files = placed.groupBy("__late", "__part", "__file").count().select(
            F.col("__file").alias("__of"), (F.coalesce(F.sum("count").over(order), F.lit(0)) + run.first).alias("__first")
        )
        numbered = placed.join(files, F.col("__file") == F.col("__of")).select(
            (F.col("__first") + F.col("__row")).alias(self.key), *columns
        )
        overwrite_partition(spark, numbered, self.table, {"run": run.number})
        runs.finish(run)
        return spark.table(self.table).where(F.col("run") == run.number).drop("run")

    def _placed(self, spark: SparkSession, run: Run) -> DataFrame:
        """The rows of a run with the file each is in and its place there."""
        return self.room.since(
            spark, run.start, run.stop,
            {"__file": F.col("_metadata.file_path"), "__row": F.col("_metadata.row_index")},
        )


@dataclass(frozen=True)
class GoldState:
    """Counts and exact sums of the facts per key, from which gold's averages are made with the dimensions as they are now.

    A run adds those of silver's new rows to the state before: it reads the new rows and one row per key.
    """

    room: WaitingRoom
    table: str
    log: str
    band: Band

    def extend(self, spark: SparkSession) -> DataFrame:
        runs = Runs(spark, self.log)
        last = runs.last()
        run = runs.open() or Run(last.number + 1, last.stop, self.room.marks(spark))
        fresh = per_key(self.room.since(spark, run.start, run.stop), self.band.key, "fact", self.band.measures)
        if not spark.catalog.tableExists(self.table):
            create_table(spark, self.table, sum_states(fresh).select("*", F.lit(0).cast("long").alias("run")), partition_by=["run"])
        if run.start != run.stop:
            if run.number not in runs.reserved:
                runs.reserve(run)
            both = sum_states(fresh).unionByName(self._state(spark, last.number))
            overwrite_partition(spark, sum_states(both), self.table, {"run": run.number})
            runs.finish(run)
        return self._state(spark, runs.done)

    def _state(self, spark: SparkSession, run: int) -> DataFrame:
        return spark.table(self.table).where(F.col("run") == run).drop("run")

    def report(self, spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
        """The averages over all facts so far."""
        band = self.band
        return averages(
            self.extend(spark), tables[band.bridge], tables[band.dimension], (band.key, band.key), band.title, band.measures
        )
