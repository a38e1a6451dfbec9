"""Deletes and key changes carried along references, computed as sets.

A delete here is a plan without rounds, for references that form no ring; ``closure.delete_closure`` follows any. Everything is a semi or anti join (delete) or a left join (update) from the changed keys down to
each child. Both keep the child rows on the streamed side, which the adaptive skew join may split.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.models.table import Reference

#: Among what blocks a change of keys: the conflicts of the map itself.
KEY_MAP = "key_map"


def cascade_delete(
    tables: dict[str, DataFrame],
    references: tuple[Reference, ...],
    root: str,
    condition: str,
) -> tuple[dict[str, DataFrame], dict[Reference, DataFrame]]:
    """Delete the root rows meeting ``condition`` and all rows that depend on them.

    Returns the surviving rows of every table reached, and for each blocking reference the
    surviving rows that still point to a deleted row; the delete is allowed only if these are
    empty. Rows with a null reference survive.
    """
    deleted: dict[str, list[DataFrame]] = {root: [tables[root].filter(condition)]}
    survivors = {root: tables[root].filter(f"NOT coalesce({condition}, false)")}
    for name in _children_first_seen(references, root):
        edges = [r for r in references if r.cascade and r.child == name and r.parent in deleted]
        gone = [(r, _keys(deleted[r.parent], r)) for r in edges]
        survivors[name] = reduce(
            lambda rows, edge: _match(rows, edge[1], edge[0], "left_anti"), gone, tables[name]
        )
        deleted[name] = [_match(tables[name], keys, r, "left_semi") for r, keys in gone]
    blocked = {
        r: _match(survivors.get(r.child, tables[r.child]), _keys(deleted[r.parent], r), r, "left_semi")
        for r in references
        if not r.cascade and r.parent in deleted
    }
    return survivors, blocked


def cascade_update(
    tables: dict[str, DataFrame],
    references: tuple[Reference, ...],
    root: str,
    column: str,
    key_map: DataFrame,
) -> tuple[dict[str, DataFrame], dict[Reference | str, DataFrame]]:
    """Replace values of a root key column by ``key_map`` (old, new) there and in its children; keys may be swapped.

    A map with ``key_conflicts`` changes nothing: the tables come back as they are, and the conflicts are among what blocks,
    under ``key_map``. A reference of several columns with a null among them refers to
    nothing and stays. Returns the changed tables, and for each blocking reference the rows that
    hold a key about to change.
    """
    conflicts = key_conflicts(tables[root], column, key_map)
    if not conflicts.isEmpty():
        return _unchanged(tables, references, root, column), {KEY_MAP: conflicts}
    moved = key_map.filter("old <> new").distinct()
    changed: dict[str, DataFrame] = {}
    blocked: dict[Reference | str, DataFrame] = {}
    todo: list[tuple[str, str, list[str]]] = [(root, column, [])]
    seen = set()
    while todo:
        name, col, beside = todo.pop(0)
        if (name, col) in seen:
            continue
        seen.add((name, col))
        changed[name] = _remap(changed.get(name, tables[name]), col, beside, moved)
        for r in references:
            if r.parent != name or col not in r.parent_key:
                continue
            child_col = r.child_key[r.parent_key.index(col)]
            beside = [c for c in r.child_key if c != child_col]
            if r.cascade:
                todo.append((r.child, child_col, beside))
            else:
                blocked[r] = _holding(tables[r.child], child_col, beside, moved, "left_semi")
    return changed, blocked


def key_conflicts(rows: DataFrame, column: str, key_map: DataFrame) -> DataFrame:
    """What makes a key map unfit for ``cascade_update``: (key, conflict), to be empty before an update.

    ``repeated``: an old key with several new ones. ``taken``: a new key that several old ones get, or that a
    row which keeps its key already has. ``null``: a key mapped to nothing, or nothing to a key.
    """
    moved = key_map.filter("old <> new").distinct()
    repeated = moved.groupBy(F.col("old").alias("key")).agg(F.count("*").alias("n")).filter("n > 1")
    shared = moved.groupBy(F.col("new").alias("key")).agg(F.count("*").alias("n")).filter("n > 1")
    staying = rows.select(F.col(column).alias("key")).join(moved.select(F.col("old").alias("key")), "key", "left_anti")
    held = moved.select(F.col("new").alias("key")).join(staying, "key", "left_semi")
    taken = shared.select("key").unionByName(held).distinct()
    none = key_map.filter("old IS NULL OR new IS NULL").select(F.coalesce("old", "new").alias("key")).distinct()
    return reduce(DataFrame.unionByName, [
        rows.select("key", F.lit(conflict).alias("conflict"))
        for rows, conflict in ((repeated, "repeated"), (taken, "taken"), (none, "null"))
    ])


def _unchanged(
    tables: dict[str, DataFrame], references: tuple[Reference, ...], root: str, column: str
) -> dict[str, DataFrame]:
    """The tables that a change of the key would reach."""
    found = [(root, column)]
    for name, col in found:
        for r in references:
            if r.cascade and r.parent == name and col in r.parent_key:
                step = (r.child, r.child_key[r.parent_key.index(col)])
                found += [step] if step not in found else []
    return {name: tables[name] for name, _ in found}


def _children_first_seen(references: tuple[Reference, ...], root: str) -> list[str]:
    """Tables below the root, each after all parents through which the delete can reach it."""
    if any(r.cascade and r.parent == r.child for r in references):
        raise ValueError("a table's reference to itself can only block a delete")
    edges = {(r.parent, r.child) for r in references if r.cascade and r.parent != r.child}
    below, frontier = set(), {root}
    while frontier:
        frontier = {c for p, c in edges if p in frontier} - below
        below |= frontier
    if root in below:
        raise ValueError("the references form a ring through the root")
    order: list[str] = []
    while len(order) < len(below):
        ready = [
            n for n in sorted(below - set(order))
            if not any(c == n and p in below and p not in order for p, c in edges)
        ]
        if not ready:
            raise ValueError("references form a cycle")
        order += ready
    return order


def _keys(parts: list[DataFrame], reference: Reference) -> DataFrame:
    """Deleted parent keys; repeats are harmless to a semi or anti join."""
    picked = [
        part.select(*[F.col(p).alias(f"__{c}") for c, p in
                      zip(reference.child_key, reference.parent_key)])
        for part in parts
    ]
    return reduce(DataFrame.unionByName, picked)


def _match(rows: DataFrame, keys: DataFrame, reference: Reference, how: str) -> DataFrame:
    return rows.join(keys, [rows[c] == keys[f"__{c}"] for c in reference.child_key], how)


def _holding(
    rows: DataFrame, column: str, beside: list[str], moved: DataFrame, how: str
) -> DataFrame:
    """The rows joined to the moved key in ``column``, if the columns beside it are not null."""
    pairs = moved.select(F.col("old").alias("__old"), F.col("new").alias("__new"))
    condition = [rows[column] == pairs["__old"], *[rows[c].isNotNull() for c in beside]]
    return rows.join(pairs, condition, how)


def _remap(rows: DataFrame, column: str, beside: list[str], moved: DataFrame) -> DataFrame:
    joined = _holding(rows, column, beside, moved, "left")
    return joined.withColumn(column, F.coalesce("__new", column)).drop("__old", "__new")
