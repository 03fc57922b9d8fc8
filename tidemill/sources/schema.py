"""Declared schemas: Avro documents, enforcement and drift."""

from __future__ import annotations

import json
from collections.abc import Mapping
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from ..functions import col

#: Avro type names and the Spark type each one stands for.
AVRO_TYPES: dict[str, DataType] = {
    "string": StringType(),
    "int": IntegerType(),
    "long": LongType(),
    "float": FloatType(),
    "double": DoubleType(),
    "boolean": BooleanType(),
    "bytes": BinaryType(),
}


def avro_schema(document: str | Mapping[str, Any]) -> StructType:
    """Flat Avro record schema to a Spark schema; ``["null", T]`` makes the field nullable."""
    record = json.loads(document) if isinstance(document, str) else document
    return StructType([_avro_field(f) for f in record["fields"]])


def _avro_field(field: Mapping[str, Any]) -> StructField:
    kind, nullable = field["type"], False
    if isinstance(kind, list):
        nullable = "null" in kind
        others = [k for k in kind if k != "null"]
        if len(others) != 1:
            raise ValueError(f"field {field['name']}: only unions with null are supported")
        kind = others[0]
    if isinstance(kind, Mapping):
        logical = kind.get("logicalType")
        if logical == "decimal":
            return StructField(field["name"], DecimalType(kind["precision"], kind.get("scale", 0)), nullable)
        if logical == "date":
            return StructField(field["name"], DateType(), nullable)
        if logical in ("timestamp-millis", "timestamp-micros"):
            return StructField(field["name"], TimestampType(), nullable)
        kind = kind["type"]
    if kind not in AVRO_TYPES:
        raise ValueError(f"field {field['name']}: type {kind!r} is not supported")
    return StructField(field["name"], AVRO_TYPES[kind], nullable)


def as_schema(schema: StructType | str) -> StructType:
    return schema if isinstance(schema, StructType) else StructType.fromDDL(schema)


def declare(df: DataFrame, schema: StructType | str) -> DataFrame:
    """Give declared columns their types; a value that does not fit fails the job.

    Columns the schema does not know pass through. A declared column that is absent may be
    filled by a later step when it is nullable, and raises otherwise.
    """
    types = {f.name: f for f in as_schema(schema)}
    missing = [n for n, f in types.items() if n not in df.columns and not f.nullable]
    if missing:
        raise ValueError(f"declare: columns {missing} not found; available: {df.columns}")
    return df.select(*[col(c).cast(types[c].dataType).alias(c) if c in types else col(c) for c in df.columns])


def _breaks(field: StructField) -> Column:
    """A value that is present but cannot take the declared type, or a forbidden null."""
    value = col(field.name)
    broken = value.isNotNull() & value.try_cast(field.dataType).isNull()
    return broken if field.nullable else broken | value.isNull()


#: Column in which a rejected row names the declared columns it breaks.
FAILED_COLUMNS = "failed_columns"


def broken_columns(df: DataFrame, schema: StructType | str) -> Column:
    """Names of the declared columns whose values a row breaks, joined by commas; empty for a row that conforms.

    Columns must all be present (a missing one raises).
    """
    declared = as_schema(schema)
    missing = [f.name for f in declared if f.name not in df.columns]
    if missing:
        raise ValueError(f"enforce_schema: columns {missing} not found; available: {df.columns}")
    return F.concat_ws(",", *[F.when(_breaks(f), F.lit(f.name)) for f in declared])


def conforming(df: DataFrame, schema: StructType | str) -> DataFrame:
    """Exactly the declared columns in their types, of rows that conform."""
    return df.select(*[col(f.name).try_cast(f.dataType).alias(f.name) for f in as_schema(schema)])


def enforce_schema(df: DataFrame, schema: StructType | str) -> tuple[DataFrame, DataFrame]:
    """Split rows into (typed rows that conform, rejected rows as they came).

    Columns must all be present (a missing one raises). Conforming rows carry exactly the
    declared columns and types; rejected rows keep their own columns plus ``failed_columns``.
    """
    failed = broken_columns(df, schema)
    bad = reduce(lambda a, b: a | b, [_breaks(f) for f in as_schema(schema)])
    return conforming(df.filter(~bad), schema), df.filter(bad).withColumn(FAILED_COLUMNS, failed)


def schema_drift(df: DataFrame, schema: StructType | str) -> DataFrame:
    """One row per declared or actual column.

    ``status`` is ``match``, ``type_changed``, ``missing`` or ``unexpected``; ``invalid`` counts
    the values that do not fit the declared type. All columns are checked in one pass.
    """
    declared = as_schema(schema)
    actual = {f.name: f for f in df.schema}
    rows = []
    for f in declared:
        have = actual.get(f.name)
        if have is None:
            rows.append((f.name, f.dataType.simpleString(), None, "missing"))
        else:
            same = have.dataType == f.dataType
            rows.append((f.name, f.dataType.simpleString(), have.dataType.simpleString(), "match" if same else "type_changed"))
    known = {f.name for f in declared}
    rows += [(n, None, f.dataType.simpleString(), "unexpected") for n, f in actual.items() if n not in known]
    counts = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(_breaks(f)).alias(f"invalid_{i}") for i, f in enumerate(declared) if f.name in actual],
    )
    report = []
    for i, (name, expected, found, status) in enumerate(rows):
        checked = expected is not None and found is not None
        report.append(
            F.struct(
                F.lit(name).alias("column"),
                F.lit(expected).cast("string").alias("expected_type"),
                F.lit(found).cast("string").alias("actual_type"),
                F.lit(status).alias("status"),
                F.col("rows").alias("rows"),
                (F.col(f"invalid_{i}") if checked else F.lit(0).cast("long")).alias("invalid"),
            )
        )
    return counts.select(F.inline(F.array(*report)))
