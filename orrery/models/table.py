"""How a table is described: typed fields, key, length limits and references."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

INT = T.IntegerType()
LONG = T.LongType()
DOUBLE = T.DoubleType()
DATE = T.DateType()
TEXT = T.StringType()


def money(precision: int = 8) -> T.DecimalType:
    return T.DecimalType(precision, 2)


@dataclass(frozen=True)
class Field:
    """One column. Text limits are audited, not enforced by a padded or raising type."""

    name: str
    type: T.DataType
    required: bool = False
    length: int | None = None


@dataclass(frozen=True)
class Reference:
    """A foreign key. ``cascade`` follows deletes and updates; otherwise they are blocked."""

    child: str
    child_key: tuple[str, ...]
    parent: str
    parent_key: tuple[str, ...]
    cascade: bool = True


@dataclass(frozen=True)
class Table:
    name: str
    key: tuple[str, ...]
    fields: tuple[Field, ...]

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.type, True) for f in self.fields])

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.fields if f.required]

    @property
    def lengths(self) -> dict[str, int]:
        return {f.name: f.length for f in self.fields if f.length is not None}


@dataclass(frozen=True)
class Dimension:
    """A dimension table: its source, and the natural-to-warehouse column names."""

    name: str
    source: Table
    renames: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Hop:
    """One join of the star: which dimension, on which columns, and what it adds."""

    dimension: str
    on: dict[str, str]
    keep: dict[str, str]


@dataclass(frozen=True)
class Band:
    """The gold report: average measures per title over fact, bridge and dimension.

    ``measures`` maps an output column to (side, column), side being fact, bridge or dim.
    """

    bridge: str
    dimension: str
    key: str
    title: str
    measures: dict[str, tuple[str, str]]
    order_by: str


@dataclass(frozen=True)
class Star:
    """A feed of facts, its dimensions, the joins and columns of silver, and the gold report.

    ``date`` is silver's date column, whose range the date dimension covers; ``references`` are those
    between the sources.
    """

    feed: Table
    dimensions: tuple[Dimension, ...]
    hops: tuple[Hop, ...]
    silver: dict[str, str]
    date: str
    gold: Band
    references: tuple[Reference, ...] = ()
