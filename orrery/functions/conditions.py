"""Document-style conditions as a Spark filter expression.

A null value and an absent field are the same thing in a DataFrame. Equality with null and
``$ne``/``$nin`` against a value match missing fields; the range operators never do. Comparisons
stay plain so that they reach the file reader as pushed filters.
"""

from __future__ import annotations

from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def has_field(schema: T.StructType, name: str) -> bool:
    """Whether documents of this schema can hold the field; a dot steps into nested documents or their arrays."""
    kind: T.DataType = schema
    for step in name.split("."):
        while isinstance(kind, T.ArrayType):
            kind = kind.elementType
        if isinstance(kind, T.MapType):
            kind = kind.valueType
        elif isinstance(kind, T.StructType) and step in kind.names:
            kind = kind[step].dataType
        else:
            return False
    return True


def matches(conditions: dict[str, Any], schema: T.StructType) -> Column:
    """True where a document meets every condition."""
    return _all([_clause(name, wanted, schema) for name, wanted in conditions.items()])


def _clause(name: str, wanted: Any, schema: T.StructType) -> Column:
    if name == "$and":
        return _all([matches(part, schema) for part in wanted])
    if name == "$or":
        if not wanted:
            raise ValueError("$or needs at least one alternative")
        return reduce(Column.__or__, [matches(part, schema) for part in wanted])
    if name.startswith("$"):
        raise ValueError(f"unknown condition {name}")
    field = F.col(name) if has_field(schema, name) else F.lit(None)
    if isinstance(wanted, dict):
        return _all([_compare(field, operator, value) for operator, value in wanted.items()])
    return _equal(field, wanted)


def _compare(field: Column, operator: str, value: Any) -> Column:
    match operator:
        case "$eq":
            return _equal(field, value)
        case "$ne":
            return field.isNotNull() if value is None else field.isNull() | (field != value)
        case "$gt":
            return field > value
        case "$gte":
            return field >= value
        case "$lt":
            return field < value
        case "$lte":
            return field <= value
        case "$in":
            return _one_of(field, value)
        case "$nin":
            return _none_of(field, value)
        case "$exists":
            return field.isNotNull() if value else field.isNull()
    raise ValueError(f"unknown operator {operator}")


def _equal(field: Column, value: Any) -> Column:
    return field.isNull() if value is None else field == value


def _one_of(field: Column, values: list[Any]) -> Column:
    listed = field.isin([v for v in values if v is not None])
    return listed | field.isNull() if None in values else listed


def _none_of(field: Column, values: list[Any]) -> Column:
    unlisted = ~field.isin([v for v in values if v is not None])
    return field.isNotNull() & unlisted if None in values else field.isNull() | unlisted


def _all(parts: list[Column]) -> Column:
    return reduce(Column.__and__, parts, F.lit(True))
