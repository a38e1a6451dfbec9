"""Fact construction and the end-to-end rebuild of a star's lakehouse."""

from __future__ import annotations

from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.models.table import Star
from orrery.operators.audits import pk_duplicates
from orrery.operators.conform import dimension
from orrery.operators.dates import date_dim_extend, date_dim_of
from orrery.operators.joins import Dim, star_join
from orrery.operators.keys import number_rows
from orrery.plans.landing import Landing, land_audited
from orrery.session import append_log, read_log, remove
from orrery.sinks.catalog import create_database, drop_database, insert_rows, overwrite_table
from orrery.streaming.increments import Facts, GoldState
from orrery.streaming.medallion import (
    IDENTITY, WaitingRoom, bronze, dims_of, evolve, release, silver, with_identity,
)


def keyed_dimension(df: DataFrame, natural_key: list[str], key: str) -> DataFrame:
    """A dimension, one row per natural key, with a dense surrogate key in natural-key order.

    Natural keys that come twice are refused, since each of their rows would get a key; ``pk_duplicates`` lists them all.
    """
    repeated = pk_duplicates(df, natural_key).orderBy(*natural_key).limit(3).collect()
    if repeated:
        raise ValueError(f"natural keys {natural_key} come more than once, such as {[tuple(r) for r in repeated]}")
    return number_rows(df, key, natural_key, unique=True)


def build_fact(
    feed: DataFrame,
    dims: list[Dim],
    key: str,
    columns: dict[str, str],
    order_by: list[str] | None = None,
    unique: bool = False,
) -> DataFrame:
    """Fact rows: a generated key, the dimension keys reached by the joins, and the measures.

    ``columns`` maps a fact column to a column of the joined rows. The key numbers the rows as
    they come out of the joins, or in the order of the fact columns ``order_by``, which are
    ``unique`` if no two rows agree in them.
    """
    rows = star_join(feed, dims).select(
        *[F.col(source).alias(name) for name, source in columns.items()]
    )
    return number_rows(rows, key, order_by, unique=unique)


@dataclass(frozen=True)
class Lakehouse:
    """Where a star's tables live: a database, and a root folder that all executors share."""

    database: str
    root: str

    def table(self, name: str) -> str:
        return f"{self.database}.{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/checkpoints/{name}"

    def room(self) -> WaitingRoom:
        return WaitingRoom(
            self.table("fact_silver"), self.table("fact_silver_late"), self.table("fact_waiting"), self.checkpoint("late")
        )

    def landing(self, limits: dict[str, int] | None = None) -> Landing:
        return Landing(self.database, f"{self.root}/dimensions", self.checkpoint("loads"), limits or {})

    def fact(self) -> Facts:
        return Facts(self.room(), self.table("fact"), self.checkpoint("fact"))

    def gold_state(self, star: Star) -> GoldState:
        return GoldState(self.room(), self.table("gold_state"), self.checkpoint("gold_state"), star.gold)

    def base(self) -> Lakehouse:
        """The place that all generations of this one have in common."""
        if _GENERATION not in self.root:
            return self
        return Lakehouse(self.database.rpartition(_GENERATION.replace("/", "_"))[0], self.root.rpartition(_GENERATION)[0])

    def fresh(self) -> Lakehouse:
        """The next generation: a database and a folder of its own, beside those of the others."""
        base, mark = self.base(), uuid4().hex
        return Lakehouse(
            f"{base.database}{_GENERATION.replace('/', '_')}{mark}", f"{base.root}{_GENERATION}{mark}"
        )

    def drop(self, spark: SparkSession) -> None:
        """Drop the database and delete its files; generations below a base stay."""
        drop_database(spark, self.database)
        if self.root != self.base().root:
            remove(spark, self.root, below=self.base().root)
        else:
            for part in ("tables", "checkpoints", "dimensions"):
                remove(spark, f"{self.root}/{part}", below=self.root)


#: What sets a generation's folder (and, with an underscore, its database) apart from its base.
_GENERATION = "/generation_"


def live(spark: SparkSession, place: Lakehouse) -> Lakehouse:
    """The generation that the last successful rebuild made, or the place itself if there was none."""
    base = place.base()
    built = sorted(read_log(spark, f"{base.root}/live"), key=lambda e: e["number"])
    return Lakehouse(built[-1]["database"], built[-1]["root"]) if built else base


def open_lakehouse(
    spark: SparkSession, place: Lakehouse, comment: str = "", fresh: bool = False
) -> Lakehouse:
    """Create the database if needed. ``fresh`` opens the next generation instead, which leaves this one as it is."""
    if fresh:
        place = place.fresh()
    create_database(
        spark, place.database, f"{place.root}/tables", comment, {"contains_pii": "true"}
    )
    return place


def land_dimensions(
    spark: SparkSession, star: Star, place: Lakehouse, sources: dict[str, DataFrame]
) -> dict[str, DataFrame]:
    """Conform every dimension and replace its table; the tables by name."""
    for spec in star.dimensions:
        overwrite_table(dimension(sources[spec.source.name], spec), place.table(spec.name))
    return {spec.name: spark.table(place.table(spec.name)) for spec in star.dimensions}


def land_dates(star: Star, place: Lakehouse, fact: DataFrame) -> DataFrame:
    """The date dimension over the facts' own range, extended when later facts reach further."""
    spark, table = fact.sparkSession, place.table("dim_date")
    wanted = date_dim_of(fact, star.date)
    if not spark.catalog.tableExists(table):
        overwrite_table(wanted, table)
    else:
        added, _ = date_dim_extend(spark.table(table), wanted)
        insert_rows(added, table)
    return spark.table(table)


def take_in(
    spark: SparkSession,
    star: Star,
    place: Lakehouse,
    feed: str,
    tables: dict[str, DataFrame],
    multi_line: bool = True,
    max_files: int | None = None,
    late: bool = False,
) -> DataFrame:
    """Bring what has arrived in ``feed`` through bronze to silver; all facts.

    Documents come as arrays over many lines or, with ``multi_line=False``, one per line, which
    lets large files be split and is read about twice as fast. ``max_files`` bounds the files per micro-batch of both streams. ``late`` also tries the
    rows again that lacked a dimension so far, and reads none but those. Fields that the feed has and the schema lacks become
    columns of bronze with the next run.
    """
    bronze_table, room, versions = place.table("fact_bronze"), place.room(), place.checkpoint("versions")
    dims, columns = dims_of(star.hops, tables), with_identity(star.silver)
    bronze(
        spark, feed, star.feed.schema, bronze_table, place.checkpoint("bronze"),
        multi_line=multi_line, max_files=max_files, versions=versions,
    )
    evolve(spark, bronze_table, versions, star.feed.schema)
    silver(
        spark, bronze_table, dims, columns, room.silver, place.checkpoint("silver"),
        max_files=max_files, waiting_table=room.waiting,
    )
    if late:
        release(spark, room, dims, columns)
    return facts(spark, place)


def facts(spark: SparkSession, place: Lakehouse) -> DataFrame:
    """Silver as streamed, together with the rows that were complete only later."""
    return place.room().facts(spark).drop(*IDENTITY)


def refresh(
    spark: SparkSession,
    star: Star,
    place: Lakehouse,
    sources: dict[str, DataFrame],
    feed: str,
    limits: dict[str, int] | None = None,
    **intake: bool | int,
) -> DataFrame:
    """Replace the dimensions, take in new facts, number them, extend the dates and add to gold; the gold report.

    Dimensions land under audit: their violations are listed, and beyond ``limits`` the whole refresh is refused before
    anything has changed. Fact table, dates and gold read only what silver gained. ``intake`` holds options of ``take_in``.
    """
    tables = land_audited(spark, star, place.landing(limits), sources)
    take_in(spark, star, place, feed, tables, **intake)
    land_dates(star, place, place.fact().extend(spark))
    table = place.table("fact_gold")
    overwrite_table(place.gold_state(star).report(spark, tables), table)
    return spark.table(table).orderBy(star.gold.order_by, star.gold.title)


def rebuild(
    spark: SparkSession,
    star: Star,
    place: Lakehouse,
    sources: dict[str, DataFrame],
    feed: str,
    limits: dict[str, int] | None = None,
    **intake: bool | int,
) -> tuple[Lakehouse, DataFrame]:
    """Start over in the next generation and refresh everything there.

    Only when that has succeeded does the new generation become the live one, which ``live`` finds, and the ones before it are
    deleted with all their tables, files and checkpoints. If it fails, what it made is deleted and the old one lives on.
    Returns where the lakehouse now lives, which later refreshes need, and the gold report.
    """
    old = live(spark, place)
    new = open_lakehouse(spark, old, fresh=True)
    try:
        report = refresh(spark, star, new, sources, feed, limits, **intake)
    except BaseException:
        new.drop(spark)
        raise
    log = f"{place.base().root}/live"
    built = read_log(spark, log)
    append_log(spark, log, {"number": len(built) + 1, "database": new.database, "root": new.root})
    for gone in {old, place, place.base()} - {new}:
        gone.drop(spark)
    return new, report
