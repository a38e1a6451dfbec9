"""Small helpers for column expressions."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once.

    An expression used inside a lambda is computed again for each element; bound to a variable it is not.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def shielded(run: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Let input columns that begin with an underscore pass under other names, so that helper columns, which all do, never
    meet them. Columns named in the call keep theirs."""

    @wraps(run)
    def inner(df: DataFrame, *args, **options) -> DataFrame:
        named = {v for v in (*args, *options.values()) if isinstance(v, str)}
        prefix = "kept"
        while any(c.startswith(prefix) for c in df.columns):
            prefix += "+"
        names = {c: f"{prefix}{k}" for k, c in enumerate(df.columns) if c.startswith("_") and c not in named}
        return run(df.withColumnsRenamed(names), *args, **options).withColumnsRenamed({v: k for k, v in names.items()})

    return inner
