"""JSON documents kept whole: every field, known or not, as a variant; and the log of schemas found in them."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orrery.session import append_log, read_log

_FIELDS = "map<string,variant>"


def parse_documents(pieces: DataFrame, text: str, multi_line: bool) -> DataFrame:
    """One row per document: ``fields`` (its fields by name) and ``malformed``, beside the other columns.

    ``text`` holds one document, or with ``multi_line`` an array of them (a single one also counts). What is no
    JSON document is one row with its text in ``malformed``. A field that comes twice is there twice.
    """
    marked = F.col(text).startswith("\ufeff")
    value = F.when(marked, F.expr(f"substring(`{text}`, 2)")).otherwise(F.col(text))
    others = [c for c in pieces.columns if c != text]
    some = pieces.where(value.rlike(r"\S")) if not multi_line else pieces
    one = F.from_json(value, _FIELDS)
    if not multi_line:
        found = some.select(*others, one.alias("fields"), F.col(text).alias("__text"))
        return found.select(*others, "fields", F.when(F.col("fields").isNull(), F.col("__text")).alias("malformed"))
    listed = F.coalesce(F.from_json(value, f"array<{_FIELDS}>"), F.array(one))
    # Only what is malformed keeps the text: with a copy beside each document a file's cost would be the square of its size.
    each = F.transform(listed, lambda f: F.struct(f.alias("fields"), F.when(f.isNull(), F.col(text)).alias("malformed")))
    return some.where(F.length(F.trim(value)) > 0).select(*others, F.inline(each))


def as_text(fields: Column, name: str) -> Column:
    """A field as text: a number with all its digits, nested values as JSON, null if it is null or not there."""
    return F.element_at(fields, name).cast("string")


def repeated(fields: Column) -> Column:
    """True where a document names a field twice."""
    return F.size(F.array_distinct(F.map_keys(fields))) < F.size(fields)


def whole(fields: Column) -> Column:
    """The document as one variant; of a field that comes twice the first."""
    entries = F.map_entries(fields)
    names = F.map_keys(fields)
    first = F.filter(entries, lambda e, i: F.array_position(names, e["key"]) == i + 1)
    return F.to_variant_object(F.when(repeated(fields), F.map_from_entries(first)).otherwise(fields))


def left_over(fields: Column, known: list[str], misfits: Column) -> Column:
    """JSON of the fields that are not known or are listed in ``misfits``, null if there are none.

    A document that names a field twice is left over as a whole.
    """
    known_names = F.array(*[F.lit(n) for n in known]) if known else F.array().cast("array<string>")
    rest = F.map_filter(fields, lambda k, _: ~F.array_contains(known_names, k) | F.array_contains(misfits, k))
    # A filter of a map costs as much as parsing the document: only those that leave something go through it.
    names = F.map_keys(fields)
    odd = (F.size(misfits) > 0) | ((names != known_names) & (F.size(F.array_except(names, known_names)) > 0))
    return F.when(repeated(fields), F.to_json(fields)).when(odd, F.when(F.size(rest) > 0, F.to_json(rest)))


@dataclass(frozen=True)
class Version:
    """A schema in force. ``through`` is the last batch that was looked through for new fields."""

    number: int
    schema: T.StructType
    through: int = -1


def versions(spark: SparkSession, log: str) -> list[Version]:
    """All versions in order, each as it was last noted."""
    noted = [Version(r["number"], T.StructType.fromJson(r["schema"]), r["through"]) for r in read_log(spark, log)]
    latest = {v.number: v for v in sorted(noted, key=lambda v: (v.number, v.through))}
    return list(latest.values())


def current_version(spark: SparkSession, log: str, start: T.StructType) -> Version:
    """The newest version; the first one is ``start``."""
    known = versions(spark, log)
    if known:
        return known[-1]
    _note(spark, log, Version(1, start))
    return Version(1, start)


def _note(spark: SparkSession, log: str, version: Version) -> None:
    append_log(spark, log, {
        "number": version.number, "schema": json.loads(version.schema.json()), "through": version.through,
    })


def note_new_fields(rows: DataFrame, log: str, version: Version, through: int, document: str = "document") -> Version:
    """A new version if the rows' documents have fields that the current one lacks, else the current one.

    Types come from the schemas of all documents, merged as Spark merges them: a field of mixed types becomes text, a field that is
    always null waits. A name that differs from a known one by case only stays left over, since columns
    do not tell case apart.
    """
    merged = rows.agg(F.schema_of_variant_agg(document)).first()[0]
    known = {f.name.lower() for f in version.schema.fields}
    fresh = []
    for field in variant_schema(merged).fields:
        if field.name.lower() not in known and not isinstance(field.dataType, T.NullType):
            known.add(field.name.lower())
            fresh.append(field)
    grown = T.StructType([*version.schema.fields, *fresh])
    new = Version(version.number + bool(fresh), grown, through)
    _note(rows.sparkSession, log, new)
    return new


def variant_schema(text: str) -> T.StructType:
    """The fields of a schema as ``schema_of_variant`` writes it, with types that a table can hold."""
    if not text.startswith("OBJECT<"):
        return T.StructType()
    # The word may also be part of a quoted name.
    ddl = re.sub(r"`(?:[^`]|``)*`|OBJECT<", lambda m: "STRUCT<" if m[0] == "OBJECT<" else m[0], text)
    found = T.StructType.fromDDL(f"found {ddl}")["found"].dataType
    return T.StructType([
        f if isinstance(f.dataType, T.NullType) else T.StructField(f.name, _storable(f.dataType)) for f in found.fields
    ])


def _storable(kind: T.DataType) -> T.DataType:
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _storable(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_storable(kind.elementType))
    if isinstance(kind, T.VariantType | T.NullType):
        return T.StringType()
    if isinstance(kind, T.DecimalType):
        # Digits seen so far say little of those to come.
        return T.DecimalType(38, max(kind.scale, 10))
    return kind
