"""Repeated and overlapping deliveries into a table that holds each reading once."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gustline.defaults import AUDIT
from gustline.functions import quoted
from gustline.operators import drop_duplicate_rows, require_columns
from gustline.plans.tables import LayerTables
from gustline.sources import shared_folder


def latest_versions(df: DataFrame, keys: Sequence[str], latest_by: str = AUDIT) -> DataFrame:
    """Of the rows of one key the one with the greatest ``latest_by``, as ``drop_duplicate_rows`` has it.

    A row that lacks a part of its key is no version of another: such rows are merged only where they
    agree in everything but ``latest_by``.
    """
    require_columns(df, [*keys, latest_by])
    rest = [name for name in df.columns if name not in keys and name != latest_by]
    if not rest:
        return drop_duplicate_rows(df, keys, latest_by)
    incomplete = reduce(or_, (quoted(name).isNull() for name in keys))
    apart = "_".join(["apart", *df.columns])
    told_apart = df.withColumn(apart, F.when(incomplete, F.struct(*map(quoted, rest))))
    return drop_duplicate_rows(told_apart, [*keys, apart], latest_by).drop(apart)


def merge_deliveries(
    spark: SparkSession,
    delivered: DataFrame,
    tables: LayerTables,
    keys: Sequence[str],
    latest_by: str = AUDIT,
    layer: str = "ingestion",
) -> list[dt.date | None]:
    """Merges delivered readings into a layer's table by key; returns the days it touched.

    Deliveries may repeat and overlap each other and the table, in any order of time: afterwards
    each key has the version with the greatest ``latest_by``, so several merges equal one over all.
    The keys must include the event time, from which the day follows: then every version of a
    reading is stored under one day, and the days of the delivery are all that is read and written.

    The delivery is computed once, into a table in the shared folder. Old and new rows of the
    touched days are combined in the map tasks and shuffled once, by key. Each touched day is
    replaced when the job commits; until then readers see the old one, and a failed job leaves it.
    """
    if not tables.replaces_days(layer):
        raise ValueError("Deliveries are merged into tables whose days are replaced, such as daily_parquet_tables")
    if tables.event_time not in keys:
        raise ValueError(f"The keys must include the event time {tables.event_time!r}: it tells the day of a reading")
    require_columns(delivered, [*keys, latest_by])
    staged = shared_folder(spark, "deliveries")
    stored = tables.dated(delivered)
    stored.write.parquet(staged)
    new = spark.read.schema(stored.schema).parquet(staged)
    days = [row[0] for row in new.select(quoted(tables.day_column)).distinct().collect()]
    if not days:
        return []
    old = tables.readings(spark, layer, days=days, expected=delivered.schema)
    together = old.unionByName(new.drop(tables.day_column), allowMissingColumns=True)
    tables.write_readings(layer, latest_versions(together, keys, latest_by))
    return days
