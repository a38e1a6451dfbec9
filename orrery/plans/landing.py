"""Dimensions landed under audit: counted while they are written, and put in place only if the counts allow it.

All tables of a load are first written to unused folders. The rules of a single row are counted in that same
pass (``DataFrame.observe``), keys and references from what was written. Every violation goes to a table, one partition
per load. If a limit is exceeded the load is refused and the tables stay as they are; else each table is
pointed at its new folder, so nothing is written twice and a reader of the old rows is not disturbed.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from orrery.models.table import Dimension, Star
from orrery.operators.audits import broken_rules, fk_orphans, pk_duplicates, row_key
from orrery.operators.conform import dimension
from orrery.session import append_log, read_log, remove
from orrery.sinks.catalog import create_table, overwrite_partition, point_table

VIOLATIONS = "table_name string, rule string, key string, value string, load long"
_BROKEN = "__broken"


class LandingRefused(ValueError):
    """A load with more violations than allowed: ``counts`` by table and rule."""

    def __init__(self, load: int, counts: dict[tuple[str, str], int], exceeded: list[str]) -> None:
        super().__init__(f"load {load} is refused: {', '.join(exceeded)}")
        self.load, self.counts = load, counts


@dataclass(frozen=True)
class Landing:
    """Where landed tables live: a function from a table's short name to its name in the catalog, a folder for
    their files, the table of violations and the log of loads.

    ``limits`` maps a kind of rule (required, length, type, key, reference), or a rule of one column such as
    ``required:job_id``, to how many violations a table may have of it at most; other rules have no limit.
    """

    database: str
    root: str
    log: str
    limits: dict[str, int] = field(default_factory=dict)

    def table(self, name: str) -> str:
        return f"{self.database}.{name}"

    def violations(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.table("violations"))


def land_audited(
    spark: SparkSession, star: Star, landing: Landing, sources: dict[str, DataFrame]
) -> dict[str, DataFrame]:
    """Audit all dimensions and put them in place together; the tables by name. Raises ``LandingRefused``."""
    load = max((e["load"] for e in read_log(spark, landing.log)), default=0) + 1
    folders = {d.name: f"{landing.root}/{d.name}/{load}-{uuid4().hex}" for d in star.dimensions}
    counts: dict[tuple[str, str], int] = {}
    staged = {}
    for spec in star.dimensions:
        staged[spec.name], found = _stage(sources[spec.source.name], spec, folders[spec.name])
        counts |= {(spec.name, rule): n for rule, n in found.items() if rule != "rows" and n}
    broken = [
        staged[d.name].select(F.lit(d.name).alias("table_name"), F.inline(_BROKEN)) for d in star.dimensions
    ]
    sets = [_repeated_keys(staged[d.name], d) for d in star.dimensions] + _orphans(staged, star)
    if not spark.catalog.tableExists(landing.table("violations")):
        create_table(spark, landing.table("violations"), spark.createDataFrame([], VIOLATIONS), partition_by=["load"])
    overwrite_partition(
        spark, reduce(DataFrame.unionByName, broken + sets), landing.table("violations"), {"load": load}
    )
    of_sets = F.col("rule").startswith("key:") | F.col("rule").startswith("reference:")
    listed = landing.violations(spark).where((F.col("load") == load) & of_sets).groupBy("table_name", "rule").count()
    counts |= {(r["table_name"], r["rule"]): r["count"] for r in listed.collect()}
    exceeded = [
        f"{n} of {rule} in {table} (limit {limit})"
        for (table, rule), n in sorted(counts.items())
        if (limit := landing.limits.get(rule, landing.limits.get(rule.split(":")[0]))) is not None and n > limit
    ]
    append_log(spark, landing.log, {
        "load": load, "refused": bool(exceeded), "counts": [[*k, n] for k, n in sorted(counts.items())], "folders": folders,
    })
    if exceeded:
        for folder in folders.values():
            remove(spark, folder, below=landing.root)
        raise LandingRefused(load, counts, exceeded)
    for spec in star.dimensions:
        point_table(spark, landing.table(spec.name), staged[spec.name].drop(_BROKEN).schema, folders[spec.name])
    _drop_folders(spark, landing, load)
    return {d.name: spark.table(landing.table(d.name)) for d in star.dimensions}


def _stage(rows: DataFrame, spec: Dimension, folder: str) -> tuple[DataFrame, dict[str, int]]:
    """Write the dimension with each row's broken rules; the written rows, and how often each rule is broken."""
    rules, broken = broken_rules(rows, spec.source)
    seen = Observation()
    marked = dimension(rows.withColumn(_BROKEN, broken), spec, beside=[_BROKEN])
    counted = [F.coalesce(F.sum(_times(rule)), F.lit(0)).alias(rule) for rule in rules]
    marked.observe(seen, F.count("*").alias("rows"), *counted).write.parquet(folder)
    return rows.sparkSession.read.schema(marked.schema).parquet(folder), seen.get


def _times(rule: str) -> Column:
    return F.size(F.filter(_BROKEN, lambda broken: broken["rule"] == rule))


def _repeated_keys(rows: DataFrame, spec: Dimension) -> DataFrame:
    key = [spec.renames.get(k, k) for k in spec.source.key]
    return pk_duplicates(rows, key).select(
        F.lit(spec.name).alias("table_name"), F.lit(f"key:{'/'.join(key)}").alias("rule"),
        row_key(tuple(key)).alias("key"), F.col("n_rows").cast("string").alias("value"),
    )


def _orphans(staged: dict[str, DataFrame], star: Star) -> list[DataFrame]:
    """Keys without a row in the parent, for the references between dimensions of the star."""
    specs = {d.source.name: d for d in star.dimensions}
    found = []
    for r in star.references:
        if r.child not in specs or r.parent not in specs:
            continue
        child, parent = specs[r.child], specs[r.parent]
        own = [child.renames.get(c, c) for c in r.child_key]
        theirs = [parent.renames.get(c, c) for c in r.parent_key]
        found.append(fk_orphans(staged[child.name], own, staged[parent.name], theirs).select(
            F.lit(child.name).alias("table_name"), F.lit(f"reference:{'/'.join(own)}").alias("rule"),
            row_key(tuple(own)).alias("key"), F.col("n_rows").cast("string").alias("value"),
        ))
    return found


def _drop_folders(spark: SparkSession, landing: Landing, load: int) -> None:
    """Delete what no table points at but the load before this one, which may still be read."""
    accepted = sorted((e for e in read_log(spark, landing.log) if not e["refused"]), key=lambda e: e["load"])
    for entry in accepted[:-2]:
        for folder in entry["folders"].values():
            remove(spark, folder, below=landing.root)
