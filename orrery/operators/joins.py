"""The star join and the rows it would lose.

No side carries a broadcast hint. Spark broadcasts a dimension only while its size stays below
``spark.sql.autoBroadcastJoinThreshold``, from file statistics when planning and from shuffle
statistics when running. A larger dimension is joined by shuffle, where the adaptive skew join
splits a hot key's partition; ``salts`` splits it without relying on run-time statistics. A salted
dimension is always joined by shuffle: file statistics know nothing of its copies.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Dim:
    """A dimension of a star join.

    ``on`` maps a column of the rows so far to the dimension's key column, ``keep`` an output
    column to the dimension's column. With ``salts`` above 1 the rows of one key spread over that
    many partitions by a hash of ``spread_by``, and the dimension is repeated once per salt.
    Rows equal in ``spread_by`` stay together; those only the adaptive join splits.
    """

    df: DataFrame
    on: dict[str, str]
    keep: dict[str, str] = field(default_factory=dict)
    salts: int = 1
    spread_by: tuple[str, ...] = ()


def star_join(fact: DataFrame, dims: list[Dim], how: str = "inner") -> DataFrame:
    """Join the dimensions in order; a later one may use columns that an earlier one added.

    With the inner join, a row whose key is null or unknown is dropped; ``unmatched`` shows it.
    Duplicate keys of a dimension multiply rows, as in SQL.
    """
    return reduce(lambda rows, dim: _join(rows, dim, how), dims, fact)


def unmatched(fact: DataFrame, dims: list[Dim]) -> DataFrame:
    """Fact rows that the inner star join drops, with the dimensions that lack their key.

    ``missing`` holds the positions (from 0) of those dimensions. A key reached through another
    dimension counts as missing too when that dimension has no row. The dimensions' keys must be
    unique, which ``audits.pk_duplicates`` checks.
    """
    return flagged(fact, dims).select(*fact.columns, "missing").filter(F.size("missing") > 0)


def flagged(fact: DataFrame, dims: list[Dim]) -> DataFrame:
    """All fact rows with what the joins add, and ``missing``: the positions of the dimensions that lack their key.

    Rows that miss none are those of the inner star join.
    """
    rows = fact
    for n, dim in enumerate(dims):
        flag = f"__found{n}"
        marked = replace(dim, df=dim.df.withColumn(flag, F.lit(True)), keep={**dim.keep, flag: flag})
        rows = _join(rows, marked, "left")
    flags = [f"__found{n}" for n in range(len(dims))]
    missing = F.array_compact(F.array(*[F.when(F.col(f).isNull(), F.lit(n)) for n, f in enumerate(flags)]))
    return rows.withColumn("missing", missing).drop(*flags)


def _join(rows: DataFrame, dim: Dim, how: str) -> DataFrame:
    keys = {name: f"__key{n}" for n, name in enumerate(dim.on.values())}
    right = dim.df.select(
        *[F.col(name).alias(key) for name, key in keys.items()],
        *[F.col(name).alias(out) for out, name in dim.keep.items()],
    )
    condition = [rows[left] == right[keys[name]] for left, name in dim.on.items()]
    if dim.salts > 1:
        if how not in ("inner", "left", "left_outer", "leftouter", "left_semi", "left_anti"):
            raise ValueError(f"copies of a salted dimension would each stay unmatched in a {how} join")
        salt = F.pmod(F.xxhash64(*(dim.spread_by or rows.columns)), F.lit(dim.salts))
        rows = rows.withColumn("__salt", salt)
        right = right.withColumn(
            "__copy", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(dim.salts - 1).cast("long")))
        )
        right = right.hint("merge")
        condition.append(rows["__salt"] == right["__copy"])
    return rows.join(right, condition, how).drop(*keys.values(), "__salt", "__copy")
