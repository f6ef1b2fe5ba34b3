"""The four layers as transforms of one frame each."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame

from gustline.defaults import AUDIT, CURATED_SCHEMA, DEFAULT_RULES, ENTITY, EVENT_TIME, MEASURE, READING_SCHEMA
from gustline.functions import get_conditions
from gustline.operators import (
    add_audit_column,
    cast_cleansed_schema,
    cast_curated_schema,
    cast_ingestion_schema,
    daily_statistics,
    drop_duplicate_rows,
    flag_anomalies,
    keep_invalid,
    keep_valid,
    validation_statistics,
)


def ingestion_layer_transform(
    df: DataFrame,
    schema: dict[str, str] = READING_SCHEMA,
    audit: str = AUDIT,
    audit_time: Column | None = None,
    zone: str | None = None,
) -> DataFrame:
    """Raw text readings to typed readings with the time of the run."""
    return add_audit_column(cast_ingestion_schema(df, schema, [audit], zone), audit, audit_time)


def _checked(
    df: DataFrame, schema: dict[str, str], dynamic: Iterable[str] | None, rules: Iterable[str]
) -> tuple[DataFrame, Column]:
    typed = cast_cleansed_schema(df, schema)
    return typed, get_conditions(rules, typed, dynamic_conditions=dynamic)


def cleansed_layer_transform(
    df: DataFrame,
    schema: dict[str, str] = READING_SCHEMA,
    dynamic_conditions: Iterable[str] | None = None,
    rules: Iterable[str] = DEFAULT_RULES,
    dedupe_keys: Sequence[str] | None = None,
    latest_by: str | None = None,
) -> DataFrame:
    """Typed readings that have every value and satisfy every rule, each once."""
    typed, condition = _checked(df, schema, dynamic_conditions, rules)
    return drop_duplicate_rows(keep_valid(typed, condition), dedupe_keys, latest_by)


def quarantine_layer_transform(
    df: DataFrame,
    schema: dict[str, str] = READING_SCHEMA,
    dynamic_conditions: Iterable[str] | None = None,
    rules: Iterable[str] = DEFAULT_RULES,
) -> DataFrame:
    """The readings the cleansed layer leaves out, each once.

    Give both layers the same rules, dynamic ones included: together they then hold every
    distinct reading.
    """
    typed, condition = _checked(df, schema, dynamic_conditions, rules)
    return drop_duplicate_rows(keep_invalid(typed, condition))


def cleansing_statistics(
    df: DataFrame,
    schema: dict[str, str] = READING_SCHEMA,
    dynamic_conditions: Iterable[str] | None = None,
    rules: Iterable[str] = DEFAULT_RULES,
    dedupe_keys: Sequence[str] | None = None,
    cleansed: DataFrame | int | None = None,
) -> DataFrame:
    """What each step of the cleansed layer removes.

    ``cleansed`` is its result, once written, or the number of rows in it.
    """
    typed, condition = _checked(df, schema, dynamic_conditions, rules)
    return validation_statistics(typed, condition, dedupe_keys, cleansed)


def curated_layer_transform(
    df: DataFrame,
    schema: dict[str, str] = CURATED_SCHEMA,
    entity: str = ENTITY,
    event_time: str = EVENT_TIME,
    measure: str = MEASURE,
    zone: str | None = None,
) -> DataFrame:
    """One row per entity and day: mean, minimum, maximum and the anomaly flag."""
    daily = daily_statistics(df, entity, event_time, measure, zone)
    return cast_curated_schema(flag_anomalies(daily, measure), schema)
