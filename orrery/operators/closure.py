"""Deletes carried along references to their end, through rings and a table's references to itself too.

Which rows go depends on their key columns alone, so the rounds work on sets of deleted key values: a round looks only for
rows that refer to keys found in the round before, and keeps of them only keys not known yet. Each set is stored, and the rounds
read the stored key columns of the tables; so a table itself is read once for these and once for its
survivors, however many rounds there are.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orrery.models.table import Reference
from orrery.session import write_scratch

Key = tuple[str, tuple[str, ...]]


def delete_closure(
    tables: dict[str, DataFrame], references: tuple[Reference, ...], root: str, condition: str
) -> tuple[dict[str, DataFrame], dict[Reference, DataFrame]]:
    """Delete the root rows meeting ``condition`` and all rows that depend on them, directly or not.

    Returns the surviving rows of every table reached, and for each blocking reference the surviving rows that still
    point to a deleted row; the delete is allowed only if these are empty. A reference with a null among its
    columns refers to nothing.
    """
    reached = _reached(references, root)
    into = {t: [r for r in references if r.cascade and r.child == t and r.parent in reached] for t in reached}
    keys = {t: sorted({r.parent_key for r in references if r.parent == t and r.child in tables}) for t in reached}
    spark = tables[root].sparkSession
    narrow = {t: _stored(tables[t].select(*_columns(into[t], keys[t]))) for t in reached if into[t] and keys[t]}
    known: dict[Key, list[DataFrame]] = {}
    first = tables[root].where(condition)
    fresh = _new_keys(root, keys[root], _stored(first.select(*_columns([], keys[root]))) if keys[root] else first, known)
    while fresh:
        found: dict[Key, DataFrame] = {}
        for t, rows in narrow.items():
            hits = [
                _match(rows, fresh[r.parent, r.parent_key], r, "left_semi") for r in into[t] if (r.parent, r.parent_key) in fresh
            ]
            if hits:
                # A row that is found by two references is found twice, which sets of keys do not mind.
                found |= _new_keys(t, keys[t], reduce(DataFrame.unionByName, hits), known)
        fresh = found
    gone = {key: reduce(DataFrame.unionByName, parts) for key, parts in known.items()}
    empty = spark.range(0)

    def left(t: str) -> DataFrame:
        rows = tables[t].where(f"NOT coalesce({condition}, false)") if t == root else tables[t]
        for r in into[t]:
            rows = _match(rows, gone[r.parent, r.parent_key], r, "left_anti") if (r.parent, r.parent_key) in gone else rows
        return rows

    survivors = {t: left(t) for t in reached}
    blocked = {}
    for r in references:
        if not r.cascade and r.parent in reached and r.child in tables:
            rows = survivors.get(r.child, tables[r.child])
            deleted = gone.get((r.parent, r.parent_key))
            blocked[r] = rows.join(empty, F.lit(False), "left_semi") if deleted is None else _match(rows, deleted, r, "left_semi")
    return survivors, blocked


def _reached(references: tuple[Reference, ...], root: str) -> list[str]:
    """The root and the tables that a delete can reach from it, in the order found."""
    found = [root]
    for parent in found:
        found += sorted({r.child for r in references if r.cascade and r.parent == parent} - set(found))
    return found


def _columns(into: list[Reference], keys: list[tuple[str, ...]]) -> list[str]:
    return sorted({c for r in into for c in r.child_key} | {c for key in keys for c in key})


def _new_keys(
    table: str, keys: list[tuple[str, ...]], rows: DataFrame, known: dict[Key, list[DataFrame]]
) -> dict[Key, DataFrame]:
    """The rows' values of each key that are not known yet, stored and noted as known; keys without any are left out."""
    fresh = {}
    for key in keys:
        values = rows.select(*[F.col(c).alias(f"__{k}") for k, c in enumerate(key)]).dropna().distinct()
        for part in known.get((table, key), []):
            values = values.join(part, list(values.columns), "left_anti")
        values = _stored(values)
        if not values.isEmpty():
            known.setdefault((table, key), []).append(values)
            fresh[table, key] = values
    return fresh


def _stored(rows: DataFrame) -> DataFrame:
    return rows.sparkSession.table(write_scratch(rows, "keys"))


def _match(rows: DataFrame, keys: DataFrame, reference: Reference, how: str) -> DataFrame:
    condition: list[Column] = [rows[c] == keys[f"__{k}"] for k, c in enumerate(reference.child_key)]
    return rows.join(keys, condition, how)
