"""Instants and calendar days in a declared zone, whatever the session's zone is."""

from __future__ import annotations

import datetime as dt
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_DAY = 86_400_000_000  # microseconds
# Text that names no zone of its own: a date, or a date and a time.
_UNZONED = r"^\s*[+-]?\d{4,7}(-\d{1,2}){0,2}([T ]\d{1,2}(:\d{1,2}){0,2}(\.\d*)?)?\s*$"


def _instant_of_clock(clock: Column, zone: str) -> Column:
    """The instant at which clocks in the zone show an unzoned timestamp."""
    micros = (
        F.unix_date(clock.cast("date")).cast("bigint") * _DAY
        + F.hour(clock) * 3_600_000_000
        + F.minute(clock).cast("bigint") * 60_000_000
        + (F.date_part(F.lit("SECOND"), clock) * 1_000_000).cast("bigint")
    )
    return F.to_utc_timestamp(F.timestamp_micros(micros), F.lit(zone))


def instant(column: Column, kind: T.DataType, zone: str) -> Column:
    """``column`` as a zoned timestamp; text and timestamps without a zone are read in ``zone``."""
    if isinstance(kind, T.StringType):
        # The zone is appended in effect only; junk is told by a pattern before any cast is tried.
        read = _instant_of_clock(column.try_cast("timestamp_ntz"), zone)
        return F.when(column.rlike(_UNZONED), read).otherwise(column.try_cast("timestamp"))
    if isinstance(kind, (T.TimestampNTZType, T.DateType)):
        return _instant_of_clock(column.try_cast("timestamp_ntz"), zone)
    return column.try_cast("timestamp")


def local_day(column: Column, kind: T.DataType, zone: str) -> Column:
    """The calendar day that clocks in the zone show."""
    if isinstance(kind, T.StringType):
        own = local_day(column.try_cast("timestamp"), T.TimestampType(), zone)
        return F.when(column.rlike(_UNZONED), column.try_cast("date")).otherwise(own)
    if not isinstance(kind, T.TimestampType):
        return column.try_cast("date")
    shown = F.unix_micros(F.from_utc_timestamp(column, F.lit(zone)))
    return F.date_from_unix_date(F.round((shown - F.pmod(shown, F.lit(_DAY))) / _DAY).cast("int"))


def midnight(day: dt.date, zone: str) -> dt.datetime:
    """The instant at which a day begins in the zone."""
    return dt.datetime.combine(day, dt.time(), ZoneInfo(zone)).astimezone(dt.timezone.utc)
