"""Declared (PostgreSQL-spelled) column types to Spark types."""

from __future__ import annotations

import re

from pyspark.errors import ParseException
from pyspark.sql import types as T

# Spellings Spark's own type parser reads differently or not at all.
_SPARK_SPELLING = {
    "double precision": "double",
    "float4": "float",
    "float8": "double",
    "int2": "smallint",
    "int4": "int",
    "int8": "bigint",
    "text": "string",
    "timestamp with time zone": "timestamp",
    "timestamp without time zone": "timestamp",
    "timestamptz": "timestamp",
}

_NULLABILITY = re.compile(r"(\s+(not\s+)?null|\s+primary\s+key|\s+unique)+$")
_CHARACTER = re.compile(r"^(varchar|char|character)\b")
_PRECISION = re.compile(r"^(timestamp|timestamptz) ?\( ?\d+ ?\)")


def _normalise(declared: str) -> str:
    return " ".join(declared.lower().split())


def spark_type_name(declared: str) -> str:
    """Spark SQL spelling of a declared type, without the constraints declared after it.

    Lengths of character types and precisions of timestamps aren't kept: Spark's have none.
    """
    name = _PRECISION.sub(r"\1", _NULLABILITY.sub("", _normalise(declared)))
    if _CHARACTER.match(name):
        return "string"
    return _SPARK_SPELLING.get(name, name)


def spark_type(declared: str) -> T.DataType:
    """Spark type of a declared type; ``TypeError`` when Spark knows no such type."""
    try:
        return T.DataType.fromDDL(spark_type_name(declared))
    except ParseException as error:
        raise TypeError(f"Unknown column type {declared!r}") from error


def not_null_columns(schema: dict[str, str]) -> list[str]:
    """Columns declared ``NOT NULL``."""
    return [name for name, declared in schema.items() if re.search(r" not null\b", _normalise(declared))]
