"""Options of JDBC tables, for both reading and writing."""

from __future__ import annotations

import datetime as dt
import warnings
from collections.abc import Mapping
from typing import Any


def get_postgresql_options(database: str, table: str, connection: Mapping[str, Any]) -> dict[str, Any]:
    """Spark options of a table; ``connection`` holds jdbc_url, user, password and driver.

    ``ValueError`` without a JDBC URL, a warning without a password.
    """
    base = connection.get("jdbc_url")
    if not base:
        raise ValueError("The connection has no JDBC URL")
    if not connection.get("password"):
        warnings.warn("The connection has no password", stacklevel=2)
    return {
        "url": f"{base}{database}",
        "driver": connection.get("driver", "org.postgresql.Driver"),
        "user": connection.get("user", "postgres"),
        "password": connection.get("password"),
        "dbtable": table,
    }


def day_predicates(column: str, first: dt.date, last: dt.date, with_null: bool = False) -> list[str]:
    """One condition a day of a period: as the ``predicates`` of a JDBC source, each is a task of its own.

    The days are half-open ranges of the column itself, so an index on it serves each of them.
    ``with_null`` adds a task for the rows without a value.
    """
    if last < first:
        raise ValueError(f"The period ends on {last}, before it begins on {first}")
    days = [first + dt.timedelta(days=i) for i in range((last - first).days + 1)]
    name = '"' + column.replace('"', '""') + '"'
    ranges = [f"{name} >= '{day}' AND {name} < '{day + dt.timedelta(days=1)}'" for day in days]
    return ranges + [f"{name} IS NULL"] * with_null


def partitioned_read(
    column: str, lower: int | dt.date | dt.datetime, upper: int | dt.date | dt.datetime, partitions: int
) -> dict[str, Any]:
    """Options that split a JDBC scan into ranges of a numeric, date or timestamp column.

    Without them Spark reads the whole table through one connection into one task. The bounds
    only place the cuts: rows outside them, and NULLs, are still read. With few distinct or
    unevenly spread values choose the event time rather than the entity.
    """
    if partitions < 1:
        raise ValueError("A scan needs at least one partition")
    return {
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
    }
