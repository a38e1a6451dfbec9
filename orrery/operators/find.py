"""Document find: conditions, projection and sort, each honoured on its own."""

from __future__ import annotations

from functools import reduce
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.functions.conditions import has_field, matches


def find(
    df: DataFrame,
    conditions: dict[str, Any] | None = None,
    projection: dict[str, int] | list[str] | None = None,
    sort: list[tuple[str, int]] | None = None,
) -> DataFrame:
    """``projection`` lists fields or maps them to 1 (include) or 0 (exclude), not mixed.

    ``sort`` is a list of (field, 1 or -1), missing values lowest. A field no document has is
    null in the result.
    """
    out = df.filter(matches(conditions, df.schema)) if conditions else df
    if sort:
        present = [(name, step) for name, step in sort if has_field(df.schema, name)]
        # Fields that no document has are equal everywhere and order nothing.
        out = out.orderBy(*[F.asc(n) if step > 0 else F.desc(n) for n, step in present]) if present else out
    return _project(out, projection) if projection else out


def _project(df: DataFrame, projection: dict[str, int] | list[str]) -> DataFrame:
    chosen = projection if isinstance(projection, dict) else dict.fromkeys(projection, 1)
    if len({bool(flag) for flag in chosen.values()}) > 1:
        raise ValueError("a projection either includes or excludes fields")
    if not any(chosen.values()):
        return reduce(_without, chosen, df)
    return df.select(
        *[
            F.col(n) if has_field(df.schema, n) else F.lit(None).cast("string").alias(n)
            for n in chosen
        ]
    )


def _without(df: DataFrame, name: str) -> DataFrame:
    """The documents without a field; of a nested one the rest of its document stays."""
    top, _, rest = name.partition(".")
    if not rest:
        return df.drop(name)
    return df.withColumn(top, F.col(top).dropFields(rest)) if has_field(df.schema, name) else df
