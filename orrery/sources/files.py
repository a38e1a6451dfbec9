"""CSV and JSON files, directory listings, and schemas inferred once and then kept."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orrery.functions.casts import exact, from_text


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | None = None, multi_line: bool = False
) -> DataFrame:
    """CSV with a header and the literal ``NULL`` for missing values.

    Without ``schema`` types are inferred, which costs one more pass over the files. With it, columns are found
    by their names in the header, whatever their order, and a value that its type can't hold fails the read.
    ``multi_line`` allows line breaks within quotes; a file is then not split.
    """
    reader = spark.read.option("header", True).option("nullValue", "NULL").option("escape", '"')
    reader = reader.option("multiLine", multi_line)
    if not schema:
        return reader.option("inferSchema", True).csv(path)
    text = reader.csv(path)
    return text.select(*[_held(f) for f in schema.fields])


def _held(field: T.StructField) -> Column:
    """A text column as the field's type; a text that the type can't hold exactly fails the read, in any mode of Spark's."""
    text = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.StringType):
        return text.alias(field.name)
    said = F.concat(F.lit(f"column {field.name} is no {field.dataType.simpleString()}: "), text)
    fits = text.isNull() | exact(text, field.dataType)
    return F.when(fits, from_text(text, field.dataType)).otherwise(F.raise_error(said).cast(field.dataType)).alias(field.name)


def read_json(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    multi_line: bool = True,
) -> DataFrame:
    """JSON documents: arrays spread over many lines, or one document per line.

    A file holding one array cannot be split, so a large collection must come as many files;
    with ``multi_line=False`` (JSON Lines) large files are split too. A document that is not
    JSON or does not fit ``schema`` fails the read rather than being lost.
    """
    reader = spark.read.option("multiLine", multi_line).option("mode", "FAILFAST")
    if not multi_line:
        return (reader.schema(schema) if schema else reader).json(path)
    schema = schema or reader.json(path).schema
    texts_open = T.StructType([
        T.StructField(f.name, T.VariantType() if f.dataType == T.StringType() else f.dataType)
        for f in schema.fields
    ])
    return as_declared(reader.schema(texts_open).json(path), schema)


def as_declared(df: DataFrame, schema: T.StructType, *others: str) -> DataFrame:
    """The schema's fields, open ones turned into text, and the other columns named."""
    return df.select(
        *[
            F.col(f.name).cast("string").alias(f.name)
            if isinstance(df.schema[f.name].dataType, T.VariantType) else F.col(f.name)
            for f in schema.fields
        ],
        *others,
    )


def list_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Path, modification time and size of the files below ``path``; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(path)
        .select("path", "modificationTime", "length")
    )


def with_hints(inferred: T.StructType, hints: dict[str, T.DataType]) -> T.StructType:
    """The inferred schema with the named columns retyped; hinted columns not seen are added."""
    fields = [
        T.StructField(f.name, hints.get(f.name, f.dataType), True) for f in inferred.fields
    ]
    seen = {f.name for f in inferred.fields}
    fields += [T.StructField(n, t, True) for n, t in hints.items() if n not in seen]
    return T.StructType(fields)


def hinted_schema(
    spark: SparkSession,
    path: str,
    hints: dict[str, T.DataType],
    schema_location: str,
    multi_line: bool = True,
) -> T.StructType:
    """Infer the schema of the files now present, apply the hints and keep the result.

    Later calls return the kept schema, so a stream restarts with the types it began with.
    """
    kept = load_schema(spark, schema_location)
    if kept is not None:
        return kept
    schema = with_hints(read_json(spark, path, multi_line=multi_line).schema, hints)
    save_schema(spark, schema, schema_location)
    return schema


def save_schema(spark: SparkSession, schema: T.StructType, location: str) -> None:
    line = spark.range(1).select(F.lit(schema.json()).alias("value"))
    line.write.mode("overwrite").text(location)


def load_schema(spark: SparkSession, location: str) -> T.StructType | None:
    try:
        line = spark.read.text(location).first()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return T.StructType.fromJson(json.loads(line.value)) if line else None
