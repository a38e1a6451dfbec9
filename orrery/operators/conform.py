"""Bring rows to a table's declared columns, types and names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.models.table import Dimension, Table


def conform(df: DataFrame, table: Table, beside: list[str] | None = None) -> DataFrame:
    """The table's columns in order and typed; a column the source lacks is null. ``beside`` names columns to keep too.

    A value that is no value of its type becomes null; ``audit_types`` lists those beforehand.
    """
    return df.select(
        *[
            (F.col(f.name).try_cast(f.type) if f.name in df.columns else F.lit(None).cast(f.type))
            .alias(f.name)
            for f in table.fields
        ],
        *(beside or []),
    )


def conform_keys(df: DataFrame, renames: dict[str, str]) -> DataFrame:
    """Natural-key columns renamed to their warehouse names."""
    return df.withColumnsRenamed(renames)


def dimension(df: DataFrame, spec: Dimension, beside: list[str] | None = None) -> DataFrame:
    return conform_keys(conform(df, spec.source, beside), spec.renames)
