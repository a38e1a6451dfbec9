"""Mixing sources to target weights: rake token weights to marginals, then sample documents by calibrated probability.

Tokens are counted per source, language and topic. Iterative proportional fitting scales them until the shares of
every source, every language and every topic meet their targets. The weight of a cell is its tokens times one factor
per source, language and topic, so only the factors are kept: those of languages and topics in the driver while they
form a small grid, those of the sources in a table. One step sums, per language and topic, the tokens of all sources times
their factors; nothing else leaves the tasks. A document's probability is the weight per token of its cell, at most one; its draw
is a hash of its id. The weights are scaled so that the expected tokens of the sample, with probabilities held at one, are the
wanted ones: a rare cell that is kept whole takes nothing from the others. Without a wanted size they are scaled to the largest
sample in which no probability exceeds one, which the rarest cell decides.

Results for odd inputs: null sources, languages and topics are values of their own; a document without
tokens has its cell's probability; rows that share an id, whatever their texts, share one draw; targets of values without tokens are left out and the others scaled up;
an empty table gives no rows; input columns named like a result are replaced.
"""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orrery.llm.components import store
from orrery.llm.expressions import shielded
from orrery.session import scratch

RESULTS = ("n_tokens", "weight", "probability", "sampled")
NULL = "\x00"


@dataclass(frozen=True)
class Targets:
    """Shares per value; without them the observed tokens to the power ``alpha`` (1: as observed, 0: all alike)."""

    shares: Mapping[str | None, float] | None = None
    alpha: float = 1.0

    def of(self, values: Sequence[str], tokens: np.ndarray) -> np.ndarray:
        if self.shares is not None:
            wanted = {NULL if k is None else k: v for k, v in self.shares.items()}
            raw = np.array([wanted.get(v, 0.0) for v in values])
        else:
            raw = tokens**self.alpha
        raw = np.where(tokens > 0, raw, 0.0)
        return raw / raw.sum() if raw.sum() else raw


def topic_by_rules(text: Column, rules: Sequence[tuple[str, str]], default: str) -> Column:
    """The first topic whose pattern occurs in the text."""
    topic = F.lit(default)
    for name, pattern in reversed(rules):
        topic = F.when(F.coalesce(text, F.lit("")).rlike(pattern), name).otherwise(topic)
    return topic


def count_tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _value(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(NULL))


@dataclass(frozen=True)
class Factors:
    """Tables of source, language and topic, each with its values' factors (``value``, ``factor``)."""

    sources: DataFrame
    languages: DataFrame
    topics: DataFrame
    largest: float
    #: Tokens and weight per token of each cell that has both, and the tokens of all cells.
    cells: DataFrame
    total: float
    steps: int
    error: float


def rake(
    df: DataFrame, tokens: str, source: str, language: str, topic: str, *, by_source: Targets, by_language: Targets,
    by_topic: Targets, max_steps: int = 60, tolerance: float = 1e-6, max_grid: int = 10_000,
) -> Factors:
    """Fit the factors; a step is one pass over the table of sources, whose tokens per language and topic are one array.

    Beyond ``max_grid`` pairs of language and topic all factors are tables, and a step is three grouped sums over the
    cells; the result is the same. A fit that has not converged after ``max_steps`` is warned of.
    """
    spark = df.sparkSession
    path = scratch(spark, "cells")
    df.groupBy(
        _value(source).alias("source"), _value(language).alias("language"), _value(topic).alias("topic")
    ).agg(F.sum(tokens).cast("double").alias("tokens")).write.parquet(path + "-long")
    cells = spark.read.schema("source string, language string, topic string, tokens double").parquet(path + "-long")
    found = cells.groupBy("language", "topic").agg(F.sum("tokens").alias("tokens")).limit(max_grid + 1).collect()
    languages = sorted({r["language"] for r in found})
    topics = sorted({r["topic"] for r in found})
    if len(found) > max_grid or len(languages) * len(topics) > max_grid:
        return _rake_tables(
            cells, {"source": by_source, "language": by_language, "topic": by_topic}, max_steps, tolerance
        )
    grid = [(a, b) for a in languages for b in topics]
    per_source = cells.groupBy("source").agg(
        F.map_from_entries(
            F.collect_list(F.struct(F.concat_ws("\x01", "language", "topic"), F.col("tokens")))
        ).alias("by"),
        F.sum("tokens").alias("total"),
    ).select(
        "source", "total",
        F.transform(
            F.array(*[F.lit(f"{a}\x01{b}") for a, b in grid]),
            lambda k: F.coalesce(F.try_element_at("by", k), F.lit(0.0)),
        ).alias("tokens") if grid else F.expr("cast(array() as array<double>)").alias("tokens"),
    )
    per_source = per_source.withColumn("wanted", _source_target(by_source))
    per_source.write.parquet(path)
    table = spark.read.schema(per_source.schema).parquet(path)
    observed = np.zeros((len(languages), len(topics)))
    for r in found:
        observed[languages.index(r["language"]), topics.index(r["topic"])] = r["tokens"]
    want_l = by_language.of(languages, observed.sum(axis=1))
    want_t = by_topic.of(topics, observed.sum(axis=0))
    b, c = (want_l > 0).astype(float), (want_t > 0).astype(float)
    # Sources without a token in any wanted cell can't be met.
    error, steps = 0.0, 0
    for steps in range(1, max_steps + 1) if grid else ():
        sums = _grid_sums(table, b, c, len(grid))
        g = sums.reshape(len(languages), len(topics)) * b[:, None] * c[None, :]
        error = max(
            np.abs(g.sum(axis=1) - want_l * g.sum()).max(), np.abs(g.sum(axis=0) - want_t * g.sum()).max()
        ) / max(g.sum(), 1e-300)
        if error < tolerance:
            break
        for axis, want, factor in ((1, want_l, b), (0, want_t, c)):
            have = g.sum(axis=axis)
            ratio = np.divide(want, have, out=np.zeros_like(want), where=have > 0)
            factor *= ratio
            g *= ratio[:, None] if axis == 1 else ratio[None, :]
    if grid:
        _warn(steps, error, tolerance)
    sources = table.select(F.col("source").alias("value"), _factor(b, c).alias("factor"))
    pairs = F.array(*[F.lit(float(x)) for x in np.outer(b, c).ravel()]) if grid else F.array(F.lit(0.0))
    weighed = store(
        table.select(_factor(b, c).alias("f"), F.explode(F.arrays_zip("tokens", pairs.alias("p"))).alias("cell")).select(
            F.col("cell.tokens").alias("tokens"), (F.col("f") * F.col("cell.p")).alias("weight")
        ).where("tokens > 0 AND weight > 0"),
        "cells",
    )
    largest = weighed.agg(F.max("weight")).first()[0]
    sources.write.parquet(path + "-factors")
    stored = spark.read.schema(sources.schema).parquet(path + "-factors")
    small = [
        spark.createDataFrame([(v, float(f)) for v, f in zip(values, factors)], "value string, factor double")
        for values, factors in ((languages, b), (topics, c))
    ]
    return Factors(stored, *small, largest or 0.0, weighed, float(observed.sum()), steps, float(error))


def _warn(steps: int, error: float, tolerance: float) -> None:
    if error >= tolerance:
        warnings.warn(f"marginals are off by {error:.2g} of all tokens after {steps} steps", stacklevel=3)


def _rake_tables(cells: DataFrame, targets: dict[str, Targets], max_steps: int, tolerance: float) -> Factors:
    """The same with the factors of all three kinds in tables, for any number of languages and topics."""
    wanted, factors = {}, {}
    for axis, of in targets.items():
        totals = cells.groupBy(F.col(axis).alias("value")).agg(F.sum("tokens").alias("total"))
        raw = totals.select("value", F.when(F.col("total") > 0, _target(of, "value")).otherwise(0.0).alias("raw"))
        raw = store(raw, "wanted")
        whole = raw.agg(F.sum("raw")).first()[0] or 1.0
        wanted[axis] = raw.select("value", (F.col("raw") / whole).alias("wanted"))
        factors[axis] = store(wanted[axis].select("value", (F.col("wanted") > 0).cast("double").alias("factor")), "factors")

    def weighed(without: str | None = None) -> DataFrame:
        rows, weight = cells, F.lit(1.0)
        for axis, table in factors.items():
            if axis != without:
                named = table.select(F.col("value").alias(f"_{axis}"), F.col("factor").alias(f"_f_{axis}"))
                rows = rows.join(named, F.col(axis) == F.col(f"_{axis}"))
                weight *= F.col(f"_f_{axis}")
        return rows.withColumn("weight", weight)

    error, steps = 0.0, 0
    for steps in range(1, max_steps + 1):
        error = 0.0
        for axis in ("source", "language", "topic"):
            have = weighed(axis).groupBy(F.col(axis).alias("value")).agg(F.sum(F.col("tokens") * F.col("weight")).alias("have"))
            both = store(wanted[axis].join(have, "value").join(factors[axis], "value"), "sums")
            now, total = F.col("have") * F.col("factor"), both.agg(F.sum(F.col("have") * F.col("factor"))).first()[0] or 1e-300
            if steps > 1:
                error = max(error, both.agg(F.max(F.abs(now - F.col("wanted") * total))).first()[0] / total)
            ratio = F.when(F.col("have") > 0, F.col("wanted") / F.col("have")).otherwise(0.0)
            factors[axis] = store(both.select("value", ratio.alias("factor")), "factors")
        if steps > 1 and error < tolerance:
            break
    _warn(steps, error if steps > 1 else 0.0, tolerance)
    kept = store(weighed().select("tokens", "weight").where("tokens > 0 AND weight > 0"), "cells")
    largest, total = kept.agg(F.max("weight")).first()[0], cells.agg(F.sum("tokens")).first()[0]
    return Factors(*factors.values(), largest or 0.0, kept, float(total or 0.0), steps, float(error))


def _source_target(targets: Targets) -> Column:
    return _target(targets, "source")


def _target(targets: Targets, value: str) -> Column:
    """The wanted share of a value by its ``total``, unscaled: a common scale cancels out."""
    if targets.shares is None:
        return F.pow("total", F.lit(targets.alpha))
    if not targets.shares:
        return F.lit(0.0)
    items = [F.lit(x) for k, v in targets.shares.items() for x in (NULL if k is None else k, float(v))]
    return F.coalesce(F.try_element_at(F.create_map(*items), F.col(value)), F.lit(0.0))


def _factor(b: np.ndarray, c: np.ndarray) -> Column:
    """What brings a source's weight to its target, given the factors of languages and topics."""
    pairs = F.array(*[F.lit(float(x)) for x in np.outer(b, c).ravel()])
    weight = F.aggregate(F.zip_with("tokens", pairs, lambda t, p: t * p), F.lit(0.0), lambda x, y: x + y)
    return F.coalesce(F.col("wanted") / F.nullif(weight, F.lit(0.0)), F.lit(0.0))


def _grid_sums(table: DataFrame, b: np.ndarray, c: np.ndarray, size: int) -> np.ndarray:
    scaled = table.select(_factor(b, c).alias("f"), "tokens")
    sums = scaled.agg(*[F.sum(F.col("f") * F.get("tokens", F.lit(i))).alias(f"s{i}") for i in range(size)])
    return np.array([x or 0.0 for x in sums.first()])


def _scale(fitted: Factors, expected_tokens: float, max_steps: int = 60) -> float:
    """The factor of all weights at which the tokens times their probabilities, at most one each, sum to the wanted ones.

    The sum grows with the factor ever more slowly, so Newton's steps from below pass no solution; each is one pass over the
    cells. If more is wanted than there is, all cells are kept whole.
    """
    scale = 0.0
    for _ in range(max_steps):
        whole = F.col("weight") * F.lit(scale) >= 1 - 1e-12
        kept, mass = fitted.cells.agg(
            F.sum(F.when(whole, F.col("tokens"))), F.sum(F.when(~whole, F.col("tokens") * F.col("weight")))
        ).first()
        if not mass:
            break
        following = (expected_tokens - (kept or 0.0)) / mass
        if following <= scale * (1 + 1e-12):
            break
        scale = following
    else:
        warnings.warn(f"the size of the sample is not met after {max_steps} steps", stacklevel=3)
    return scale


@shielded
def mix_sources(
    df: DataFrame, doc_id: str = "doc_id", tokens: str = "n_tokens", source: str = "source",
    language: str = "lang", topic: str = "topic", *, by_source: Targets, by_language: Targets, by_topic: Targets,
    expected_tokens: float | None = None, expected_share: float | None = None, seed: int = 0,
    unnamed: str = "text",
) -> DataFrame:
    """All columns of ``df``, the weight per token, the probability and whether the document is sampled.

    ``expected_tokens``, or ``expected_share`` of all tokens, is the size of the sample.
    Rows without an id are drawn by the column ``unnamed``, if there is one.

    The tables of factors are joined without a hint: Spark broadcasts them while they are small and
    otherwise shuffles, where the adaptive join splits a large source.
    """
    df = df.drop(*[c for c in RESULTS if c != tokens])
    fitted = rake(
        df, tokens, source, language, topic,
        by_source=by_source, by_language=by_language, by_topic=by_topic,
    )
    if expected_share is not None:
        expected_tokens = expected_share * fitted.total
    if expected_tokens is not None:
        scale = _scale(fitted, expected_tokens)
    else:
        scale = 1 / fitted.largest if fitted.largest else 0.0
    rows, weight = df, F.lit(scale)
    for kind, column in (("sources", source), ("languages", language), ("topics", topic)):
        named = getattr(fitted, kind).select(F.col("value").alias(f"_{kind}"), F.col("factor").alias(f"_f_{kind}"))
        rows = rows.withColumn(f"_of_{kind}", _value(column)).join(named, F.col(f"_of_{kind}") == F.col(f"_{kind}"), "left")
        weight *= F.col(f"_f_{kind}")
    rows = rows.withColumn("weight", F.coalesce(weight, F.lit(0.0))).drop(
        *[f"{p}{kind}" for p in ("_", "_f_", "_of_") for kind in ("sources", "languages", "topics")]
    )
    key = F.xxhash64(F.lit(seed), F.col(doc_id))
    if unnamed in df.columns:
        key = F.when(F.col(doc_id).isNull(), F.xxhash64(F.lit(seed), F.col(unnamed))).otherwise(key)
    draw = F.pmod(key, F.lit(1 << 40)) / F.lit(float(1 << 40))
    return rows.withColumn("probability", F.least(F.col("weight"), F.lit(1.0))).withColumn(
        "sampled", draw < F.col("probability")
    )
