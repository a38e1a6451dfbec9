"""Quality audits: required columns, text lengths, types, unique keys, references.

The row audits share one shape, violations(rule, key, value), and one scan: each row lists its
own violations, so there is no shuffle and no pass per rule.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orrery.functions.casts import changed_by_cast
from orrery.models.table import Table


def audit(df: DataFrame, table: Table) -> DataFrame:
    """Every broken rule of the table's definition except keys and references."""
    rules = [_null(n) for n in table.required]
    rules += [_too_long(n, limit) for n, limit in table.lengths.items()]
    return _violations(df, table.key, rules)


def audit_required(df: DataFrame, key: tuple[str, ...], columns: list[str]) -> DataFrame:
    return _violations(df, key, [_null(n) for n in columns])


def audit_lengths(df: DataFrame, key: tuple[str, ...], limits: dict[str, int]) -> DataFrame:
    return _violations(df, key, [_too_long(n, limit) for n, limit in limits.items()])


def audit_types(df: DataFrame, table: Table) -> DataFrame:
    """Values that the declared type can't hold as they are: no value of it at all, or only after digits, a time of day
    or a zone are lost. Texts are judged by what they say."""
    return _violations(
        df, table.key,
        [(f"type:{f.name}", changed_by_cast(df, f.name, f.type), F.col(f.name))
         for f in table.fields if f.name in df.columns],
    )


def pk_duplicates(df: DataFrame, key: list[str]) -> DataFrame:
    """Key values held by more than one row, with the number of rows."""
    return df.groupBy(*key).agg(F.count("*").alias("n_rows")).filter("n_rows > 1")


def fk_orphans(
    child: DataFrame, child_key: list[str], parent: DataFrame, parent_key: list[str]
) -> DataFrame:
    """Child key values without a parent row, with the number of child rows holding them.

    A key with a null part refers to nothing and passes. Child rows are counted per key before
    the join, so a hot key reaches it as a single row.
    """
    refers = reduce(Column.__and__, [F.col(c).isNotNull() for c in child_key])
    held = child.filter(refers).groupBy(*child_key).agg(F.count("*").alias("n_rows"))
    known = parent.select(*[F.col(p).alias(f"__{c}") for c, p in zip(child_key, parent_key)])
    return held.join(known, [held[c] == known[f"__{c}"] for c in child_key], "left_anti")


def broken_rules(df: DataFrame, table: Table) -> tuple[list[str], Column]:
    """The rules of single rows that a source's columns are held to, and for each row those that it breaks.

    A required column that the source lacks is broken in every row.
    """
    there = [n for n in table.required if n in df.columns]
    rules = [_null(n) for n in there]
    rules += [(f"required:{n}", F.lit(True), F.lit(None)) for n in table.required if n not in there]
    rules += [_too_long(n, limit) for n, limit in table.lengths.items() if n in df.columns]
    rules += [
        (f"type:{f.name}", changed_by_cast(df, f.name, f.type), F.col(f.name)) for f in table.fields if f.name in df.columns
    ]
    return [rule for rule, _, _ in rules], F.array_compact(_listed(table.key, rules))


def row_key(key: tuple[str, ...]) -> Column:
    """A row's key as text: one column as it is, several as JSON, in which a null keeps its place."""
    if len(key) == 1:
        return F.col(key[0]).cast("string")
    return F.to_json(F.struct(*key), {"ignoreNullFields": "false"})


def _violations(
    df: DataFrame, key: tuple[str, ...], rules: list[tuple[str, Column, Column]]
) -> DataFrame:
    return df.select(F.inline(F.array_compact(_listed(key, rules))))


def _listed(key: tuple[str, ...], rules: list[tuple[str, Column, Column]]) -> Column:
    """Per rule what breaks it, or null."""
    of = row_key(key)
    return F.array(
        *[
            F.when(
                broken,
                F.struct(
                    F.lit(rule).alias("rule"),
                    of.alias("key"),
                    value.cast("string").alias("value"),
                ),
            )
            for rule, broken, value in rules
        ]
    )


def _null(name: str) -> tuple[str, Column, Column]:
    return f"required:{name}", F.col(name).isNull(), F.lit(None)


def _too_long(name: str, limit: int) -> tuple[str, Column, Column]:
    return f"length:{name}", F.length(name) > limit, F.length(name)
