"""Calendar-day operators over an event time."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from typing import Any
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gustline.defaults import EVENT_TIME
from gustline.functions import local_day, midnight, quoted


def _day(text: str) -> dt.date:
    return dt.datetime.strptime(text, "%Y-%m-%d").date()


def today_in(spark: SparkSession, zone: str | None = None) -> dt.date:
    """The current day in the zone, or in the session's zone."""
    name = zone or spark.conf.get("spark.sql.session.timeZone")
    try:
        return dt.datetime.now(ZoneInfo(name)).date()
    except (KeyError, ValueError):  # offsets and short names, which Spark knows
        return spark.sql("SELECT current_date() AS today").first().today


def period_days(
    spark: SparkSession,
    start_date: str | None = None,
    end_date: str | None = None,
    today: dt.date | None = None,
    zone: str | None = None,
) -> tuple[dt.date, dt.date]:
    """First and last day of a period: the end defaults to today, the start to the end."""
    last = _day(end_date) if end_date else (today or today_in(spark, zone))
    return (_day(start_date) if start_date else last), last


def _kind(df: DataFrame, name: str) -> T.DataType:
    return df.select(quoted(name)).schema[0].dataType


def day_of(df: DataFrame, event_time: str, zone: str | None = None) -> Column:
    """The calendar day of an event time, NULL where it can't be read."""
    column = quoted(event_time)
    return local_day(column, _kind(df, event_time), zone) if zone else column.try_cast("date")


def filter_ingestion_period(
    df: DataFrame,
    filter_column: str,
    start_date: str | None = None,
    end_date: str | None = None,
    keep_unparseable: bool = False,
    today: dt.date | None = None,
    zone: str | None = None,
) -> DataFrame:
    """Rows whose day lies within ``start_date`` and ``end_date``, both inclusive.

    The end defaults to today and the start to the end, so no dates at all means today: in the
    zone, if one is given, else in the session's. A malformed date raises ``ValueError`` before
    Spark does anything. Rows without a readable day are dropped, or kept for a later quarantine
    with ``keep_unparseable``. ``zone`` is where days begin and end, and where times are read that
    name no zone; without it that is the session's zone.

    On a timestamp column the predicate is a range on the column itself, which reaches Parquet
    row groups.
    """
    first, last = period_days(df.sparkSession, start_date, end_date, today, zone)
    kind = _kind(df, filter_column)
    day = day_of(df, filter_column, zone)
    if zone and isinstance(kind, T.TimestampType):
        column, after = quoted(filter_column), last + dt.timedelta(days=1)
        within = (column >= F.lit(midnight(first, zone))) & (column < F.lit(midnight(after, zone)))
    else:
        within = day.between(F.lit(first), F.lit(last))
    if not keep_unparseable:
        return df.filter(within)
    # A typed column is unreadable only where it is null, and that test reaches Parquet.
    typed = isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType))
    return df.filter(within | (quoted(filter_column) if typed else day).isNull())


def period_metrics(df: DataFrame, date_filter: Mapping[str, Any]) -> dict[str, Column]:
    """What a period filter sees, as aggregates: rows, rows outside the period, rows without a readable day."""
    names = ("start_date", "end_date", "today", "zone")
    first, last = period_days(df.sparkSession, **{name: date_filter.get(name) for name in names})
    day = day_of(df, date_filter["filter_column"], date_filter.get("zone"))
    return {
        "delivered": F.count(F.lit(1)),
        "outside": F.count_if(~day.between(F.lit(first), F.lit(last))),
        "unreadable": F.count_if(day.isNull()),
    }


def with_date(
    df: DataFrame, event_time: str = EVENT_TIME, name: str = "date", zone: str | None = None
) -> DataFrame:
    """Add the calendar day of the event time, in ``zone`` (default: the session's) for zoned times."""
    return df.withColumn(name, day_of(df, event_time, zone))
