"""Source to sink in one step."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gustline.plans.tables import Spec, within_period
from gustline.sinks import Writer
from gustline.sources import Reader

Transform = Callable[[DataFrame], DataFrame]


def etl(
    spark: SparkSession,
    reader: Spec,
    writer: Spec,
    date_filter: Spec | None = None,
    transform: Transform | None = None,
) -> None:
    """Read, keep the period if one is given, transform if asked to, write.

    ``date_filter`` holds the arguments of ``filter_ingestion_period``; its column defaults to
    ``ingestion_date``. CSV files with header lines are bound by name, file by file (see ``Reader``).
    The session stays the caller's.
    """
    rows = within_period(Reader.get_reader(reader).extract(spark), date_filter, "ingestion_date")
    Writer.get_writer(writer).load(rows.transform(transform) if transform else rows)
