"""Averages per title over fact ⋈ bridge ⋈ dimension on a shared key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_COUNT = "decimal(19,0)"


def gold_avg_by_group(
    fact: DataFrame,
    bridge: DataFrame,
    dim: DataFrame,
    key: tuple[str, str, str],
    title: str,
    measures: dict[str, tuple[str, str]],
) -> DataFrame:
    """``AVG`` per dimension title over the inner join of the three on ``key``.

    ``key`` names the key column in fact, bridge and dim. ``measures`` maps an output column to
    (side, column), side being ``fact``, ``bridge`` or ``dim``. Nulls do not count.

    A key with n fact rows and m bridge rows stands for n·m joined rows. These are never built:
    fact and bridge are counted and summed per key first (combined before the shuffle, so a hot
    key sends one row per task), and the joined sums are weighted by the other side's count.
    """
    return averages(per_key(fact, key[0], "fact", measures), bridge, dim, key[1:], title, measures)


def averages(
    facts: DataFrame,
    bridge: DataFrame,
    dim: DataFrame,
    key: tuple[str, str],
    title: str,
    measures: dict[str, tuple[str, str]],
) -> DataFrame:
    """The same from facts that are counted and summed per key already (``per_key``); ``key`` is that of bridge and dim."""
    b = per_key(bridge, key[0], "bridge", measures)
    wanted = {title, key[1]} | {column for side, column in measures.values() if side == "dim"}
    d = dim.select(*[F.col(c).alias(f"dim_{c}") for c in sorted(wanted)])
    joined = facts.join(b, F.col("fact_key") == F.col("bridge_key")).join(
        d, F.col("fact_key") == F.col(f"dim_{key[1]}")
    )
    found = [_average(name, side, column) for name, (side, column) in measures.items()]
    return joined.groupBy(F.col(f"dim_{title}").alias(title)).agg(*found)


def per_key(
    df: DataFrame, key: str, side: str, measures: dict[str, tuple[str, str]]
) -> DataFrame:
    """Rows, sums and counts of one side per key."""
    sums = []
    for name, (owner, column) in measures.items():
        if owner == side:
            sums.append(F.sum(column).alias(f"{name}_sum"))
            sums.append(F.count(column).cast(_COUNT).alias(f"{name}_n"))
    rows = F.count("*").cast(_COUNT).alias(f"{side}_rows")
    return df.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias(f"{side}_key")).agg(rows, *sums)


def sum_states(states: DataFrame) -> DataFrame:
    """Rows of ``per_key``, several for a key, added up; decimals as wide as they get, so that a sum can be added to."""

    def wide(name: str) -> T.DataType:
        kind = states.schema[name].dataType
        return T.DecimalType(38, kind.scale) if isinstance(kind, T.DecimalType) else kind

    key, *sums = states.columns
    return states.groupBy(key).agg(*[F.sum(c).cast(wide(c)).alias(c) for c in sums])


def _average(name: str, side: str, column: str) -> Column:
    if side == "dim":
        value = F.col(f"dim_{column}")
        weight = F.col("fact_rows") * F.col("bridge_rows")
        total, n = F.sum(value * weight), F.sum(F.when(value.isNotNull(), weight))
    else:
        weight = F.col("bridge_rows" if side == "fact" else "fact_rows")
        total, n = F.sum(F.col(f"{name}_sum") * weight), F.sum(F.col(f"{name}_n") * weight)
    n = F.when(n != 0, n)
    return (total.cast("double") / n.cast("double")).alias(name)
