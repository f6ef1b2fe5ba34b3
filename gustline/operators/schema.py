"""Declared schemas over a frame: casts, required columns, drift and column listings."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gustline.defaults import AUDIT
from gustline.functions import lenient_cast, quoted, spark_type


def require_columns(df: DataFrame, names: Iterable[str]) -> None:
    """``ValueError`` naming every column the frame lacks."""
    present = set(df.columns)
    missing = [name for name in names if name not in present]
    if missing:
        raise ValueError(f"Columns missing from the DataFrame: {missing}")


def cast_columns(
    df: DataFrame,
    schema: dict[str, str],
    skip: Iterable[str] = (),
    project: bool = False,
    zone: str | None = None,
) -> DataFrame:
    """Cast the columns named in ``schema`` in one projection.

    Values that do not convert become NULL. Columns outside the schema keep their place and
    type, unless ``project`` asks for the schema's columns only, in its order. Times without a zone
    are read in ``zone`` (default: the session's).
    """
    skipped = set(skip)
    wanted = {name: declared for name, declared in schema.items() if name not in skipped}
    require_columns(df, wanted)
    targets = {name: spark_type(declared) for name, declared in wanted.items()}

    def typed(field: T.StructField) -> Column:
        column = quoted(field.name)
        if field.name not in targets:
            return column
        return lenient_cast(column, field.dataType, targets[field.name], zone).alias(field.name)

    fields = df.schema.fields
    if project:
        fields = [df.schema[name] for name in schema if name in df.columns]
    try:
        return df.select(*map(typed, fields))
    except AnalysisException as error:
        raise TypeError(f"A column cannot be cast to its declared type: {error}") from error


def cast_ingestion_schema(
    df: DataFrame, schema: dict[str, str], skip_columns: Iterable[str] | None = None, zone: str | None = None
) -> DataFrame:
    """Raw readings to declared types; ``skip_columns`` may be absent or stay as they are."""
    return cast_columns(df, schema, skip=skip_columns or (), zone=zone)


def cast_cleansed_schema(df: DataFrame, schema: dict[str, str]) -> DataFrame:
    """Ingested readings to declared types; every column of the schema must be there."""
    if not isinstance(schema, dict):
        raise TypeError("The schema must map column names to types")
    return cast_columns(df, schema)


def cast_curated_schema(df: DataFrame, schema: dict[str, str]) -> DataFrame:
    """Turbine-day summaries to declared types."""
    return cast_columns(df, schema)


def add_audit_column(df: DataFrame, name: str = AUDIT, at: Column | None = None) -> DataFrame:
    """Stamp every row with the time of the run (one value per Spark query), or with ``at``."""
    return df.withColumn(name, F.current_timestamp() if at is None else at)


def schema_drift_report(df: DataFrame, expected: dict[str, str] | T.StructType) -> DataFrame:
    """How the frame's columns differ, in order, from the expected ones, and what that costs.

    One row per expected or surplus column: ``position`` (1-based, expected columns first),
    ``column_name``, ``expected_type``, ``actual_type``, ``status`` (match, moved,
    type_mismatch, missing, unexpected) and ``unconvertible_rows``: values present in the data
    that the expected type would turn into NULL. The counts take one scan without a shuffle of
    rows, and only over the columns whose type differs.
    """
    if isinstance(expected, T.StructType):
        wanted = {field.name: field.dataType for field in expected.fields}
    else:
        wanted = {name: spark_type(declared) for name, declared in expected.items()}
    actual = {field.name: field.dataType for field in df.schema.fields}
    order = [name for name in actual if name in wanted]
    common = [name for name in wanted if name in actual]

    def status(name: str) -> str:
        if name not in actual:
            return "missing"
        if name not in wanted:
            return "unexpected"
        if actual[name] != wanted[name]:
            return "type_mismatch"
        return "match" if order.index(name) == common.index(name) else "moved"

    names = [*wanted, *(name for name in actual if name not in wanted)]
    lost = []
    for name in names:
        if status(name) != "type_mismatch":
            lost.append(F.count_if(F.lit(False)))
            continue
        column = quoted(name)
        converted = lenient_cast(column, actual[name], wanted[name])
        lost.append(F.count_if(column.isNotNull() & converted.isNull()))

    def type_name(types: dict[str, T.DataType], name: str) -> Column:
        return F.lit(types[name].simpleString() if name in types else None).cast("string")

    counts = df.agg(*(column.alias(f"lost_{index}") for index, column in enumerate(lost)))
    rows = F.array(
        *(
            F.struct(
                F.lit(index + 1).alias("position"),
                F.lit(name).alias("column_name"),
                type_name(wanted, name).alias("expected_type"),
                type_name(actual, name).alias("actual_type"),
                F.lit(status(name)).alias("status"),
                F.col(f"lost_{index}").alias("unconvertible_rows"),
            )
            for index, name in enumerate(names)
        )
    )
    return counts.select(F.inline(rows))


# Numeric precision (bits) and scale an SQL catalog lists for each type.
_NUMERIC_SHAPE = {
    "tinyint": (8, 0),
    "smallint": (16, 0),
    "int": (32, 0),
    "bigint": (64, 0),
    "float": (24, None),
    "double": (53, None),
}


def table_column_metadata(df: DataFrame, measure_lengths: bool = False) -> DataFrame:
    """The frame's columns: position, name, type, character length, precision and scale.

    Spark text has no declared length. ``measure_lengths`` lists the longest value found
    instead, which scans the text columns (and only those) once.
    """
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    measured = text if measure_lengths else []
    lengths = {name: f"length_{index}" for index, name in enumerate(measured)}

    def entry(position: int, field: T.StructField) -> Column:
        kind = field.dataType.simpleString()
        precision, scale = _NUMERIC_SHAPE.get(kind, (None, None))
        if isinstance(field.dataType, T.DecimalType):
            precision, scale = field.dataType.precision, field.dataType.scale
        length = F.col(lengths[field.name]) if field.name in lengths else F.lit(None)
        return F.struct(
            F.lit(position).alias("position"),
            F.lit(field.name).alias("column_name"),
            F.lit(kind).alias("data_type"),
            length.cast("int").alias("character_maximum_length"),
            F.lit(precision).cast("int").alias("numeric_precision"),
            F.lit(scale).cast("int").alias("numeric_scale"),
        )

    entries = [entry(position, field) for position, field in enumerate(df.schema.fields, start=1)]
    if measured:
        one_row = df.agg(*(F.max(F.char_length(quoted(name))).alias(lengths[name]) for name in measured))
    else:
        one_row = df.sparkSession.range(1)
    return one_row.select(F.inline(F.array(*entries)))
