"""Reports over the layer tables as SQL texts with parameter markers."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from gustline.plans.tables import LayerTables

_ALWAYS = {"first_day": dt.date(1000, 1, 1), "last_day": dt.date(9999, 12, 31)}


@dataclass(frozen=True)
class Report:
    """A query over the view of one layer, and the values of its markers that need not be given."""

    layer: str
    text: str
    defaults: Mapping[str, Any] = field(default_factory=dict)


def _extremes(column: str) -> Report:
    return Report(
        "cleansed",
        f"""
        SELECT min({column}) AS min_{column}, max({column}) AS max_{column}
        FROM cleansed_table
        WHERE (:first_day IS NULL OR CAST(timestamp AS DATE) >= :first_day)
          AND (:last_day IS NULL OR CAST(timestamp AS DATE) <= :last_day)
        """,
        {"first_day": None, "last_day": None},
    )


REPORTS: dict[str, Report] = {
    "null_audit": Report(
        "ingestion",
        """
        SELECT * FROM ingestion_table
        WHERE timestamp IS NULL OR turbine_id IS NULL OR wind_speed IS NULL OR wind_direction IS NULL
           OR power_output IS NULL OR metadata_datetime_created IS NULL
        """,
    ),
    "min_max_wind_speed": _extremes("wind_speed"),
    "min_max_wind_direction": _extremes("wind_direction"),
    "min_max_power_output": _extremes("power_output"),
    "anomalous_days": Report(
        "curated",
        """
        SELECT turbine_id, count(date) AS anomalous_days
        FROM curated_table WHERE anomalous_power_output = TRUE AND date BETWEEN :first_day AND :last_day
        GROUP BY turbine_id ORDER BY anomalous_days DESC, turbine_id
        """,
        _ALWAYS,
    ),
}


def register_report(name: str, layer: str, text: str, **defaults: Any) -> None:
    """Adds a report; ``ValueError`` if there is one of that name."""
    if name in REPORTS:
        raise ValueError(f"There is a report {name!r} already")
    REPORTS[name] = Report(layer, text, defaults)


def run_report(spark: SparkSession, tables: LayerTables, name: str, **parameters: Any) -> DataFrame:
    """A report over the layer tables, through the temporary view of the layer it reads.

    Values reach the query as parameters, never as parts of its text. A value without a marker raises
    ``ValueError``; Spark refuses a marker without a value.
    """
    if name not in REPORTS:
        raise ValueError(f"No report {name!r}: one of {sorted(REPORTS)}")
    report = REPORTS[name]
    unknown = [key for key in parameters if f":{key}" not in report.text]
    if unknown:
        raise ValueError(f"The report {name!r} has no parameters {unknown}")
    tables.create_views(spark, [report.layer])
    values = {**report.defaults, **parameters}
    return spark.sql(report.text, args=values) if values else spark.sql(report.text)
