"""The tables of the four layers."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gustline.defaults import EVENT_TIME
from gustline.functions import quoted
from gustline.operators import day_of, filter_ingestion_period, with_date
from gustline.sinks import Writer
from gustline.sources import Reader

Spec = Mapping[str, Any]
Days = Sequence[dt.date | None]

LAYERS = ("ingestion", "cleansed", "quarantine", "curated")

# Fixed value: the folder name of the partition without a value.
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
# Error conditions of a table nothing has been written to yet.
_NOTHING_WRITTEN = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def within_period(df: DataFrame, date_filter: Spec | None, default_column: str, zone: str | None = None) -> DataFrame:
    if not date_filter:
        return df
    return filter_ingestion_period(df, **{"filter_column": default_column, "zone": zone, **date_filter})


def nothing_written(error: AnalysisException) -> bool:
    return str(error.getCondition()).split(".")[0] in _NOTHING_WRITTEN


def remove_partitions(spark: SparkSession, root: str, column: str, days: Iterable[dt.date | None]) -> None:
    """Removes whole partitions of a table of files, through the file system Spark itself uses for it.

    One call a partition, on the driver; a partition that isn't there is no error.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    configuration = spark._jsparkSession.sessionState().newHadoopConf()
    for day in days:
        path = hadoop.Path(f"{root.rstrip('/')}/{column}={_NO_VALUE if day is None else day.isoformat()}")
        path.getFileSystem(configuration).delete(path, True)


@dataclass(frozen=True)
class LayerTables:
    """The tables of the four layers, each a spec that serves as source and as sink.

    ``day_column`` names an extra column for the tables of readings: the day of the event time,
    to partition them by. A period is then a choice of partitions. ``zone`` is where the days of all
    four tables begin and end and where delivered times are read that name no zone; whatever the
    zone of a session, it then writes and reads the same days. Without it that is the session's zone.
    ``runs`` is a table for the records of runs.
    """

    ingestion: Spec
    cleansed: Spec
    quarantine: Spec
    curated: Spec
    day_column: str | None = None
    event_time: str = EVENT_TIME
    zone: str | None = None
    runs: Spec | None = None

    def read(self, spark: SparkSession, layer: str) -> DataFrame:
        """A layer's rows, without the day they are stored under."""
        rows = Reader.get_reader(getattr(self, layer)).extract(spark)
        return rows.drop(self.day_column) if self.day_column else rows

    def readings(
        self,
        spark: SparkSession,
        layer: str,
        date_filter: Spec | None = None,
        days: Days | None = None,
        expected: T.StructType | None = None,
    ) -> DataFrame:
        """A layer's readings of one period, or of the named days (None: without a readable time).

        ``expected`` is the schema of the result where nothing has been written yet.
        """
        try:
            rows = Reader.get_reader(getattr(self, layer)).extract(spark)
        except AnalysisException as error:
            if expected is None or not nothing_written(error):
                raise
            return spark.createDataFrame([], expected)
        if days is not None:
            day = quoted(self.day_column) if self.day_column else day_of(rows, self.event_time, self.zone)
            known = [day_ for day_ in days if day_ is not None]
            chosen = day.isin(known) if known else F.lit(False)
            rows = rows.filter(chosen | day.isNull() if None in days else chosen)
            date_filter = None
        if not self.day_column:
            return within_period(rows, date_filter, self.event_time, self.zone)
        if date_filter and date_filter.get("filter_column", self.event_time) == self.event_time:
            date_filter = {**date_filter, "filter_column": self.day_column}
        return within_period(rows, date_filter, self.day_column, self.zone).drop(self.day_column)

    def dated(self, rows: DataFrame) -> DataFrame:
        """Readings as they are stored: with their day, if the tables are partitioned by it."""
        return with_date(rows, self.event_time, self.day_column, self.zone) if self.day_column else rows

    def write_readings(self, layer: str, rows: DataFrame, counted: Observation | None = None) -> None:
        """Write a layer's readings, with their day if the tables are partitioned by it."""
        Writer.get_writer(getattr(self, layer)).load(self.dated(rows), counted)

    def replaces_days(self, layer: str) -> bool:
        """Whether a write replaces the days it has rows for, and only those."""
        spec = getattr(self, layer)
        options = {str(key).lower(): str(value).lower() for key, value in Writer.get_writer(spec).options.items()}
        return (
            bool(self.day_column)
            and str(spec.get("mode", "")).lower() == "overwrite"
            and options.get("partitionoverwritemode") == "dynamic"
            and list(spec.get("partition_by", ())) == [self.partition(layer)]
        )

    def partition(self, layer: str) -> str | None:
        """The column of days of a layer's table."""
        return "date" if layer == "curated" else self.day_column

    def days(self, spark: SparkSession, layer: str, date_filter: Spec | None, days: Days | None) -> DataFrame:
        """The different days a layer's table holds, as ``day``, within the period or among the named ones."""
        name = self.partition(layer)
        try:
            stored = Reader.get_reader(getattr(self, layer)).extract(spark).select(quoted(name).cast("date").alias("day"))
        except AnalysisException as error:
            if not nothing_written(error):
                raise
            return spark.createDataFrame([], "day date")
        if days is not None:
            known = [day for day in days if day is not None]
            stored = stored.filter((F.col("day").isin(known) if known else F.lit(False)) | F.lit(None in days) & F.col("day").isNull())
        elif date_filter:
            stored = within_period(stored, {**date_filter, "filter_column": "day"}, "day", self.zone)
        return stored.distinct()

    def drop_days_without(self, spark: SparkSession, layer: str, source: DataFrame, date_filter: Spec | None, days: Days | None) -> Days:
        """Removes the days of the period that a layer still holds, though ``source`` (column ``day``) lacks them.

        Only the days, at most those of the period, come to the driver.
        """
        if not self.replaces_days(layer):
            return []
        stale = [row.day for row in self.days(spark, layer, date_filter, days).subtract(source).collect()]
        root = Writer.get_writer(getattr(self, layer)).options["path"]
        remove_partitions(spark, root, self.partition(layer), stale)
        return stale

    def create_views(self, spark: SparkSession, layers: Iterable[str] = LAYERS) -> None:
        """Temporary views ``ingestion_table``, ``cleansed_table`` and so on, for SQL."""
        for layer in layers:
            self.read(spark, layer).createOrReplaceTempView(f"{layer}_table")


def _runs(root: str) -> Spec:
    return {"format": "parquet", "path": f"{root}/runs", "mode": "append"}


def parquet_tables(
    root: str, mode: str = "append", event_time: str = EVENT_TIME, zone: str | None = None
) -> LayerTables:
    """The four tables as Parquet folders below ``root``."""
    specs = ({"format": "parquet", "path": f"{root}/{name}", "mode": mode} for name in LAYERS)
    return LayerTables(*specs, event_time=event_time, zone=zone, runs=_runs(root))


def daily_parquet_tables(
    root: str, day_column: str = "day", event_time: str = EVENT_TIME, zone: str | None = None
) -> LayerTables:
    """Parquet folders partitioned by day, in which a run replaces the days it covers.

    Running a period again gives the same tables, provided the raw files still hold its days: a day
    that yields no valid (or no invalid) row any more leaves the table that held it.
    """
    replacing = {"format": "parquet", "mode": "overwrite", "partitionOverwriteMode": "dynamic"}
    readings = ({**replacing, "path": f"{root}/{name}", "partition_by": [day_column]} for name in LAYERS[:3])
    curated = {**replacing, "path": f"{root}/curated", "partition_by": ["date"]}
    return LayerTables(*readings, curated, day_column, event_time, zone, _runs(root))
