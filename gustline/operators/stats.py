"""Statistics per entity and day, and the reports over them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gustline.defaults import ANOMALY_SIGMAS, ENTITY, EVENT_TIME, MEASURE
from gustline.functions import quoted
from gustline.operators.periods import with_date


def daily_statistics(
    df: DataFrame,
    entity: str = ENTITY,
    event_time: str = EVENT_TIME,
    measure: str = MEASURE,
    zone: str | None = None,
) -> DataFrame:
    """Mean, minimum, maximum and population standard deviation per entity and day.

    All four are combined in the map tasks, so the shuffle carries one small record per entity,
    day and task, however many readings one entity has.
    """
    value = quoted(measure)
    return (
        with_date(df, event_time, zone=zone)
        .groupBy(quoted(entity), "date")
        .agg(
            F.mean(value).alias(f"mean_{measure}"),
            F.min(value).alias(f"min_{measure}"),
            F.max(value).alias(f"max_{measure}"),
            F.stddev_pop(value).alias(f"stddev_{measure}"),
        )
    )


def flag_anomalies(daily: DataFrame, measure: str = MEASURE, sigmas: float = ANOMALY_SIGMAS) -> DataFrame:
    """Replace the standard deviation by a flag: an extreme lies strictly beyond the band.

    No reading of n can be further than sqrt(n - 1) population deviations from its mean, so two
    sigmas need at least six readings a day. Days without any value are not anomalous.
    """
    mean, spread = quoted(f"mean_{measure}"), sigmas * quoted(f"stddev_{measure}")
    outside = (quoted(f"max_{measure}") > mean + spread) | (quoted(f"min_{measure}") < mean - spread)
    flag = F.when(outside, True).otherwise(False)
    return daily.withColumn(f"anomalous_{measure}", flag).drop(f"stddev_{measure}")


def min_max(df: DataFrame, column: str) -> DataFrame:
    """Smallest and largest value of a column over the whole frame, as one row."""
    return df.agg(F.min(quoted(column)).alias(f"min_{column}"), F.max(quoted(column)).alias(f"max_{column}"))


def anomalous_days(curated: DataFrame, entity: str = ENTITY, measure: str = MEASURE) -> DataFrame:
    """Anomalous days per entity, most first; entities without any are left out."""
    return (
        curated.filter(quoted(f"anomalous_{measure}"))
        .groupBy(quoted(entity))
        .agg(F.count("date").alias("anomalous_days"))
        .orderBy(F.desc("anomalous_days"), quoted(entity))
    )


def preview(df: DataFrame, order_by: Sequence[str], rows: int = 10) -> DataFrame:
    """The first rows in the given order; each task keeps only its own first rows."""
    return df.orderBy(*map(quoted, order_by)).limit(rows)
