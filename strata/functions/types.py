"""Logical types: how they are cast and which stored types satisfy them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Logical type -> Spark type used when text has to be read as that type.
CAST_TARGETS = {
    "integer": "int",
    "long": "bigint",
    "double": "double",
    "float": "float",
    "string": "string",
    "boolean": "boolean",
    "timestamp": "timestamp",
    "date": "date",
}

# Logical type -> stored types that count as a match.
ACCEPTED_TYPES = {
    "integer": (T.ByteType, T.ShortType, T.IntegerType, T.LongType),
    "long": (T.ByteType, T.ShortType, T.IntegerType, T.LongType),
    "double": (T.FloatType, T.DoubleType, T.DecimalType, T.IntegerType, T.LongType),
    "string": (
        T.StringType, T.IntegerType, T.LongType, T.DoubleType, T.FloatType, T.TimestampType, T.DateType,
        T.BooleanType,
    ),
    "timestamp": (T.TimestampType, T.TimestampNTZType, T.StringType, T.DateType, T.LongType),
    "date": (T.DateType, T.TimestampType, T.StringType),
}


def whole_number(value: Column, target: str = "int") -> Column:
    """An integer from text or number; a fraction is cut off, as "5.0" for an hour should read 5."""
    return F.coalesce(value.try_cast(target), value.try_cast("double").try_cast(target))


def cast_declared(df: DataFrame, expected: Mapping[str, str]) -> DataFrame:
    """Read the declared columns as their logical types in one projection; undeclared columns pass through.

    Values that do not parse become null, and logical types without a cast target are left alone.
    """
    def typed(field: T.StructField):
        target = CAST_TARGETS.get(expected.get(field.name, ""))
        column = F.col(f"`{field.name}`")
        if target is None or field.dataType.simpleString() == target:
            return column
        if target in ("int", "bigint") and isinstance(field.dataType, T.StringType):
            return whole_number(column, target).alias(field.name)
        return column.try_cast(target).alias(field.name)

    return df.select(*[typed(f) for f in df.schema.fields])


def align_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast the columns shared with ``schema`` to its types in one projection; new columns pass through."""
    stored = {f.name: f.dataType for f in schema.fields}

    def aligned(field):
        column = F.col(f"`{field.name}`")
        target = stored.get(field.name, field.dataType)
        return column if target == field.dataType else column.try_cast(target).alias(field.name)

    return df.select(*[aligned(f) for f in df.schema.fields])


def schema_errors(schema: T.StructType, expected: Mapping[str, str]) -> list[str]:
    """One message per declared column that is absent or stored as an unsuitable type; extra columns are fine."""
    stored = {f.name: f.dataType for f in schema.fields}
    errors = []
    for name, logical in expected.items():
        if name not in stored:
            errors.append(f"missing column: {name}")
        elif logical in ACCEPTED_TYPES and not isinstance(stored[name], ACCEPTED_TYPES[logical]):
            errors.append(f"{name}: got {stored[name].simpleString()}, expected {logical}")
    return errors
