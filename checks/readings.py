"""Turbine readings derived from the ``events`` table, in Spark and in SQL.

The test tables hold no sensor readings, no missing values and no repeated rows, so the layers
would have nothing to do on them. Every event becomes one reading by integer arithmetic; some
break a rule, some miss their power value, and every tenth event is delivered twice. The whole
table takes part, and the readings grow with it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the injected time of the run, so that results can be compared.
AUDIT_TIME = "2024-02-01 00:00:00"

READINGS_SQL = """
    SELECT user_id AS turbine_id,
           ts AS timestamp,
           CAST(event_id % 311 AS DOUBLE) / 10 AS wind_speed,
           CAST((event_id * 37) % 400 AS INTEGER) AS wind_direction,
           CASE WHEN event_id % 23 = 0 THEN NULL
                WHEN event_id % 19 = 0 THEN 0 - value
                ELSE value END AS power_output
    FROM (SELECT *, UNNEST(CASE WHEN event_id % 10 = 0 THEN [1, 2] ELSE [1] END) AS delivery
          FROM events)
"""

# The typed readings after ingestion of the dirtied text (see raw_readings): a value whose text
# cannot be read is NULL, and a fractional direction lost its fraction.
INGESTED_SQL = f"""
    SELECT CASE WHEN event_id % 41 = 0 THEN NULL ELSE ts END AS timestamp,
           CAST(user_id AS INTEGER) AS turbine_id,
           CASE WHEN event_id % 43 = 0 THEN NULL
                ELSE CAST(event_id % 311 AS DOUBLE) / 10 END AS wind_speed,
           CASE WHEN event_id % 29 = 0 THEN NULL
                ELSE CAST((event_id * 37) % 400 AS INTEGER) END AS wind_direction,
           CASE WHEN event_id % 23 = 0 THEN NULL
                WHEN event_id % 19 = 0 THEN 0 - value
                ELSE value END AS power_output,
           TIMESTAMP '{AUDIT_TIME}' AS metadata_datetime_created
    FROM (SELECT *, UNNEST(CASE WHEN event_id % 10 = 0 THEN [1, 2] ELSE [1] END) AS delivery
          FROM events)
"""

VALID_SQL = """
    wind_speed BETWEEN 0 AND 25 AND wind_direction BETWEEN 0 AND 360 AND power_output >= 0
    AND turbine_id IS NOT NULL AND timestamp IS NOT NULL
"""


def every(n: int) -> Column:
    """TRUE for each n-th event."""
    return F.col("event_id") % n == 0


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as delivered: every tenth one twice, from a single scan."""
    times = F.when(every(10), 2).otherwise(1)
    return events(spark, sf_dir).withColumn("delivery", F.explode(F.array_repeat(F.lit(1), times)))


def _wind_speed() -> Column:
    return (F.col("event_id") % 311).cast("double") / 10


def _wind_direction() -> Column:
    return ((F.col("event_id") * 37) % 400).cast("int")


def _power_output() -> Column:
    return F.when(every(23), None).when(every(19), 0 - F.col("value")).otherwise(F.col("value"))


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed readings: what READINGS_SQL says."""
    return deliveries(spark, sf_dir).select(
        F.col("user_id").alias("turbine_id"),
        F.col("ts").alias("timestamp"),
        _wind_speed().alias("wind_speed"),
        _wind_direction().alias("wind_direction"),
        _power_output().alias("power_output"),
    )


def raw_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The readings as the text a CSV would hold, some of it unreadable, padded or fractional."""
    direction = _wind_direction().cast("string")
    return deliveries(spark, sf_dir).select(
        F.when(every(41), "no clock").otherwise(F.col("ts").cast("string")).alias("timestamp"),
        F.when(every(31), F.concat(F.lit(" +"), F.col("user_id").cast("string"), F.lit(" ")))
        .otherwise(F.col("user_id").cast("string"))
        .alias("turbine_id"),
        F.when(every(43), "n/a").otherwise(_wind_speed().cast("string")).alias("wind_speed"),
        F.when(every(29), "north")
        .when(every(7), F.concat(direction, F.lit(".7")))
        .otherwise(direction)
        .alias("wind_direction"),
        _power_output().cast("string").alias("power_output"),
    )


def unzoned(df: DataFrame) -> DataFrame:
    """Timestamps without zone, as the SQL side has them."""
    names = [name for name, kind in df.dtypes if kind == "timestamp"]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in names})


def rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    """Averages differ in their last bits with the order of addition."""
    return df.withColumns({name: F.round(name, digits) for name in names})
