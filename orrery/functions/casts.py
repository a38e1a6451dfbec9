"""Casts that lose nothing unseen: a value that the target type can't hold exactly is a misfit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Beyond the point of a plain number; a number with an exponent is compared as a decimal instead.
_EXPONENT = r"^\s*[+-]?[0-9.]+[eE]"
_ZONE = r"(Z|UTC|GMT|[+-]\d{1,2}(:?\d{2}){0,2}|[A-Za-z]+/[A-Za-z_]+)\s*$"


def misfit(name: str, target: T.DataType) -> Column:
    """True where a text is present but the target type has no value for all that it says."""
    return F.col(name).isNotNull() & ~exact(F.col(name), target)


def changed_by_cast(df: DataFrame, name: str, target: T.DataType) -> Column:
    """True where a column's value, cast to the target type and back, is no longer the same.

    A text is judged by what it says (``exact``), any other value by the way back.
    """
    value, source = F.col(name), df.schema[name].dataType
    if source == target:
        return F.lit(False)
    if isinstance(source, T.StringType):
        return misfit(name, target)
    back = value.try_cast(target).try_cast(source)
    return value.isNotNull() & ~F.coalesce(back == value, F.lit(False))


def exact(text: Column, target: T.DataType, value: Column | None = None) -> Column:
    """True where the target type has a value for the text that keeps all it says.

    Decimals keep every digit but zeros at the end; doubles and floats must print as the same number again; a date has no time of
    day but midnight, a timestamp nothing below microseconds, and one without a zone names none. Nested values
    must be JSON of their shape; fields they lack are not looked for. ``value`` is a column that holds what ``from_text`` gives.
    """
    value = from_text(text, target) if value is None else value
    kept = F.lit(True)
    if isinstance(target, T.DecimalType):
        plain = text.rlike(rf"^\s*[+-]?\d*(\.\d{{0,{target.scale}}}0*)?\s*$")
        wide = T.DecimalType(38, 38 - (target.precision - target.scale))
        kept = plain | (text.rlike(_EXPONENT) & (text.try_cast(wide) == value.cast(wide)))
    elif isinstance(target, T.DoubleType | T.FloatType):
        digits = T.DecimalType(38, 18)
        said, printed = text.try_cast(digits), value.cast("string").try_cast(digits)
        finer = text.rlike(r"\.\d{18}\d*[1-9]")
        kept = said.isNull() | ((said == printed) & ~finer)
    elif isinstance(target, T.DateType):
        kept = text.try_cast("timestamp_ntz") == value.cast("timestamp_ntz")
    elif isinstance(target, T.TimestampType):
        kept = ~text.rlike(r"\.\d{6}\d*[1-9]")
    elif isinstance(target, T.TimestampNTZType):
        kept = ~text.rlike(r"\.\d{6}\d*[1-9]") & ~text.rlike(r"\d[T ].*" + _ZONE)
    return value.isNotNull() & F.coalesce(kept, F.lit(False))


def from_text(text: Column, target: T.DataType) -> Column:
    """The value a text stands for, null if it stands for none; nested values are JSON."""
    if isinstance(target, T.StructType | T.ArrayType | T.MapType):
        return F.try_variant_get(F.try_parse_json(text), "$", target.simpleString())
    return text.try_cast(target)


def cast_fields(df: DataFrame, schema: T.StructType, misfits: str) -> DataFrame:
    """Text fields cast to their types, beside the other columns; a value that does not fit exactly becomes null.

    ``misfits`` lists the names of the fields that did not fit.
    """
    cast = [f for f in schema.fields if not isinstance(f.dataType, T.StringType)]
    raw = {f.name: f"__raw_{f.name}" for f in cast}
    # Each text is cast and judged once: an expression used in several branches would be computed in each.
    value = {f.name: F.col(f"__value_{f.name}") for f in cast}
    fits = {f.name: F.col(f"__fits_{f.name}") for f in cast}
    both = df
    if cast:
        both = df.withColumnsRenamed(raw)
        both = both.withColumns({f"__value_{f.name}": from_text(F.col(raw[f.name]), f.dataType) for f in cast})
        both = both.withColumns({
            f"__fits_{f.name}": F.col(raw[f.name]).isNull() | exact(F.col(raw[f.name]), f.dataType, value[f.name]) for f in cast
        })
        both = both.withColumns({f.name: F.when(fits[f.name], value[f.name]) for f in cast})
    found = [F.when(~fits[f.name], F.lit(f.name)) for f in cast]
    listed = F.array_compact(F.array(*found)) if found else F.array().cast("array<string>")
    others = [c for c in df.columns if c not in schema.names]
    return both.select(*schema.names, *others, listed.alias(misfits))
