"""Every operator as a query over the test tables, beside the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.readings import (
    AUDIT_TIME,
    INGESTED_SQL,
    READINGS_SQL,
    VALID_SQL,
    deliveries,
    events,
    every,
    raw_readings,
    readings,
    rounded,
    unzoned,
)
from gustline.defaults import AUDIT, CURATED_SCHEMA, DEFAULT_RULES, READING_SCHEMA
from gustline.functions import get_conditions, holds
from gustline.operators import (
    add_audit_column,
    anomalous_days,
    audit_null_rows,
    cast_cleansed_schema,
    cast_curated_schema,
    cast_ingestion_schema,
    constraint_violations,
    daily_statistics,
    declared_violations,
    drop_duplicate_rows,
    filter_ingestion_period,
    keep_valid,
    min_max,
    preview,
    table_column_metadata,
    with_date,
)
from gustline.plans import (
    Flow,
    LayerTables,
    cleansed_layer_transform,
    cleansing_statistics,
    curated_layer_transform,
    daily_parquet_tables,
    etl,
    ingestion_layer_transform,
    parquet_tables,
    quarantine_layer_transform,
    run_flow,
    run_layer,
    run_layers,
    run_report,
    shared_folder,
)
from gustline.plans import merge_deliveries as merge_into
from gustline.sinks import Writer
from gustline.sources import Reader, read_csv_directory

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _audit_time() -> Column:
    return F.lit(AUDIT_TIME).cast("timestamp")


def query(sql: str) -> Callable[[Query], Query]:
    """Register a query under its function's name, without the suffix that tells it from the operator."""

    def register(function: Query) -> Query:
        name = function.__name__.removesuffix("_query")
        QUERIES[name] = function
        ORACLES[name] = sql
        return function

    return register


# ---------------------------------------------------------------- sources


@query("SELECT * FROM lineitem")
def src_generic_scan(spark, sf_dir):
    spec = {"format": "parquet", "read_options": {"path": f"{sf_dir}/lineitem.parquet"}}
    return Reader.get_reader(spec).extract(spark)


@query("SELECT * FROM orders")
def src_inferred_format(spark, sf_dir):
    return Reader.get_reader({"path": f"{sf_dir}/orders.parquet"}).extract(spark)


@query(
    """
    SELECT CAST(event_id AS VARCHAR) AS event_id,
           CAST(user_id AS VARCHAR) AS user_id,
           CASE WHEN event_id % 13 = 0 THEN NULL ELSE event_type END AS event_type
    FROM events
    """
)
def src_csv_permissive(spark, sf_dir):
    """Some lines end a field early, others carry a field too many."""
    event_id, user_id = F.col("event_id").cast("string"), F.col("user_id").cast("string")
    line = (
        F.when(every(13), F.concat_ws(",", event_id, user_id))
        .when(every(17), F.concat_ws(",", event_id, user_id, "event_type", F.lit("surplus")))
        .otherwise(F.concat_ws(",", event_id, user_id, "event_type"))
    )
    folder = shared_folder(spark, "csv-permissive")
    # One column named like the header, under a separator the text does not hold: Spark writes
    # each line as it is and the header line into every file.
    lines = events(spark, sf_dir).select(line.alias("event_id,user_id,event_type"))
    lines.write.csv(folder, header=True, sep="\u0001")
    spec = {"format": "csv", "read_options": {"path": folder, "header": "true", "mode": "PERMISSIVE"}}
    return Reader.get_reader(spec).extract(spark)


@query(
    """
    SELECT CAST(event_id AS VARCHAR) AS event_id,
           CAST(user_id AS VARCHAR) AS user_id,
           event_type
    FROM events
    """
)
def src_csv_multi_file(spark, sf_dir):
    """Two groups of files in one folder, their columns in different orders."""
    folder = shared_folder(spark, "csv-multi")
    rows = events(spark, sf_dir)
    first = holds(F.col("event_type") < "m")
    rows.filter(first).select("event_id", "user_id", "event_type").write.csv(folder, header=True)
    rows.filter(~first).select("event_type", "user_id", "event_id").write.csv(
        folder, header=True, mode="append"
    )
    return read_csv_directory(spark, folder, required=["event_id", "user_id", "event_type"])


@query(
    """
    SELECT * FROM (VALUES
        (1, 'event_id', 'bigint', 'bigint', 'match', CAST(0 AS BIGINT)),
        (2, 'user_id', 'int', 'bigint', 'type_mismatch',
            (SELECT count(user_id) FILTER (WHERE TRY_CAST(user_id AS INTEGER) IS NULL) FROM events)),
        (3, 'ts', 'timestamp_ntz', 'timestamp_ntz', 'moved', 0),
        (4, 'value', 'decimal(3,2)', 'double', 'type_mismatch',
            (SELECT count(value) FILTER (WHERE TRY_CAST(value AS DECIMAL(3, 2)) IS NULL) FROM events)),
        (5, 'event_type', 'double', 'string', 'type_mismatch',
            (SELECT count(event_type) FILTER (WHERE TRY_CAST(event_type AS DOUBLE) IS NULL) FROM events)),
        (6, 'quality', 'int', NULL, 'missing', 0),
        (7, 'props', NULL, 'string', 'unexpected', 0)
    ) AS t(position, column_name, expected_type, actual_type, status, unconvertible_rows)
    """
)
def schema_drift_report(spark, sf_dir):
    declared = (
        "event_id bigint, user_id int, ts timestamp_ntz, value decimal(3,2), event_type double, quality int"
    )
    spec = {"path": f"{sf_dir}/events.parquet", "schema": declared}
    return Reader.get_reader(spec).drift(spark)


# ---------------------------------------------------------------- sinks


def _write(df: DataFrame, folder: str, mode: str, **more) -> None:
    Writer.get_writer({"format": "parquet", "path": folder, "mode": mode, **more}).load(df)


def _read(spark: SparkSession, folder: str) -> DataFrame:
    return Reader.get_reader({"format": "parquet", "path": folder}).extract(spark)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("SELECT * FROM events")
def sink_parquet_roundtrip(spark, sf_dir):
    folder = shared_folder(spark, "sink-roundtrip")
    _write(events(spark, sf_dir), folder, "error")
    return _read(spark, folder)


@query("SELECT * FROM orders UNION ALL SELECT * FROM orders")
def sink_append_mode(spark, sf_dir):
    folder = shared_folder(spark, "sink-append")
    for _ in range(2):
        _write(_table(spark, sf_dir, "orders"), folder, "append")
    return _read(spark, folder)


@query("SELECT * FROM customer")
def sink_overwrite_mode(spark, sf_dir):
    folder = shared_folder(spark, "sink-overwrite")
    _write(_table(spark, sf_dir, "supplier"), folder, "error")
    _write(_table(spark, sf_dir, "customer"), folder, "overwrite")
    return _read(spark, folder)


@query("SELECT * FROM customer")
def sink_ignore_mode(spark, sf_dir):
    folder = shared_folder(spark, "sink-ignore")
    _write(_table(spark, sf_dir, "customer"), folder, "ignore")
    _write(_table(spark, sf_dir, "supplier"), folder, "ignore")
    return _read(spark, folder)


CURATED_EVENTS_SQL = """
    SELECT CAST(user_id AS INTEGER) AS turbine_id, date,
           round(avg(value), 6) AS mean_power_output,
           min(value) AS min_power_output,
           max(value) AS max_power_output,
           coalesce(max(value) > avg(value) + 2 * stddev_pop(value)
                    OR min(value) < avg(value) - 2 * stddev_pop(value), FALSE) AS anomalous_power_output
    FROM (SELECT *, CAST(ts AS DATE) AS date FROM events)
    GROUP BY user_id, date
"""


def _event_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select(
        F.col("user_id").alias("turbine_id"), F.col("ts").alias("timestamp"), F.col("value").alias("power_output")
    )


@query(CURATED_EVENTS_SQL)
def curated_layer(spark, sf_dir):
    return rounded(curated_layer_transform(_event_readings(spark, sf_dir)), "mean_power_output")


@query(CURATED_EVENTS_SQL)
def sink_partition_overwrite(spark, sf_dir):
    """The days of one period are computed again and replace themselves, and only themselves."""
    folder = shared_folder(spark, "sink-partitions")
    rows = _event_readings(spark, sf_dir)
    again = filter_ingestion_period(rows, "timestamp", "2024-01-10", "2024-01-20")
    for part in (rows, again):
        _write(
            curated_layer_transform(part),
            folder,
            "overwrite",
            partition_by=["date"],
            partitionOverwriteMode="dynamic",
        )
    return rounded(_read(spark, folder), "mean_power_output")


# ---------------------------------------------------------------- casts and derived columns


@query(f"SELECT * EXCLUDE (metadata_datetime_created) FROM ({INGESTED_SQL})")
def cast_ingestion_schema_query(spark, sf_dir):
    return unzoned(cast_ingestion_schema(raw_readings(spark, sf_dir), READING_SCHEMA, [AUDIT]))


@query(
    """
    SELECT CASE WHEN event_id % 29 = 0 THEN NULL ELSE event_id END AS event_id,
           CASE WHEN event_id % 31 = 0 THEN NULL ELSE value END AS value,
           CASE WHEN event_id % 37 = 0 THEN NULL ELSE ts END AS metadata_datetime_created,
           event_type, props
    FROM events
    """
)
def cast_cleansed_schema_query(spark, sf_dir):
    text = events(spark, sf_dir).select(
        F.when(every(29), "1e2").otherwise(F.col("event_id").cast("string")).alias("event_id"),
        F.when(every(31), "-").otherwise(F.col("value").cast("string")).alias("value"),
        F.when(every(37), "01/02/2024").otherwise(F.col("ts").cast("string")).alias(AUDIT),
        "event_type",
        "props",
    )
    schema = {
        "event_id": "BIGINT",
        "value": "DOUBLE PRECISION NOT NULL",
        "event_type": "VARCHAR(16)",
        AUDIT: "TIMESTAMP NOT NULL",
    }
    return unzoned(cast_cleansed_schema(text, schema))


@query(
    """
    SELECT CAST(o_custkey AS INTEGER) AS turbine_id,
           CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS date,
           o_totalprice AS mean_power_output,
           CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_totalprice END AS min_power_output,
           o_totalprice AS max_power_output,
           CASE WHEN o_orderstatus = 'F' THEN TRUE WHEN o_orderstatus = 'O' THEN FALSE END
               AS anomalous_power_output
    FROM orders
    """
)
def cast_curated_schema_query(spark, sf_dir):
    key, price = F.col("o_orderkey"), F.col("o_totalprice").cast("string")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    status = F.col("o_orderstatus")
    text = _table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("turbine_id"),
        F.when(key % 11 == 0, "2024-13-01").otherwise(day).alias("date"),
        price.alias("mean_power_output"),
        F.when(key % 13 == 0, "").otherwise(price).alias("min_power_output"),
        price.alias("max_power_output"),
        F.when(status == "F", "yes").when(status == "O", "f").otherwise("maybe").alias("anomalous_power_output"),
    )
    return cast_curated_schema(text, CURATED_SCHEMA)


@query(f"SELECT *, TIMESTAMP '{AUDIT_TIME}' AS metadata_datetime_created FROM orders")
def ingest_audit_column(spark, sf_dir):
    return unzoned(add_audit_column(_table(spark, sf_dir, "orders"), at=_audit_time()))


@query("SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS date FROM lineitem")
def derive_date(spark, sf_dir):
    shipped = with_date(_table(spark, sf_dir, "lineitem"), "l_shipdate")
    return shipped.select("l_orderkey", "l_linenumber", "date")


# ---------------------------------------------------------------- filters


@query("SELECT * FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-12'")
def filter_date_range(spark, sf_dir):
    return filter_ingestion_period(events(spark, sf_dir), "ts", "2024-01-05", "2024-01-12")


@query("SELECT * FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15'")
def filter_single_day(spark, sf_dir):
    return filter_ingestion_period(events(spark, sf_dir), "ts", "2024-01-15", "2024-01-15")


@query("SELECT * FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-20'")
def filter_start_defaults_to_end(spark, sf_dir):
    return filter_ingestion_period(events(spark, sf_dir), "ts", end_date="2024-01-20")


@query(
    f"""
    SELECT * EXCLUDE (metadata_datetime_created) FROM ({INGESTED_SQL})
    WHERE timestamp IS NULL OR CAST(timestamp AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-12'
    """
)
def filter_keep_unparseable(spark, sf_dir):
    rows = filter_ingestion_period(
        raw_readings(spark, sf_dir), "timestamp", "2024-01-05", "2024-01-12", keep_unparseable=True
    )
    return unzoned(cast_ingestion_schema(rows, READING_SCHEMA, [AUDIT]))


@query(
    f"""
    SELECT * FROM ({READINGS_SQL})
    WHERE wind_speed BETWEEN 0 AND 25 AND wind_direction BETWEEN 0 AND 360 AND power_output >= 0
    """
)
def rule_range_filter(spark, sf_dir):
    return keep_valid(readings(spark, sf_dir), get_conditions(DEFAULT_RULES))


@query(
    f"""
    SELECT * FROM ({READINGS_SQL})
    WHERE {VALID_SQL} AND turbine_id > 10 AND (wind_speed > 5 OR wind_direction < 90)
    """
)
def rule_dynamic_conditions(spark, sf_dir):
    rows = readings(spark, sf_dir)
    extra = ["turbine_id > 10", "wind_speed > 5 OR wind_direction < 90"]
    return keep_valid(rows, get_conditions(DEFAULT_RULES, rows, dynamic_conditions=extra))


@query(f"SELECT * FROM ({READINGS_SQL}) WHERE power_output IS NOT NULL")
def rule_no_nulls(spark, sf_dir):
    rows = readings(spark, sf_dir)
    return keep_valid(rows, get_conditions([], rows))


# ---------------------------------------------------------------- layers and quality

TYPED_SQL = f"""
    SELECT CAST(turbine_id AS INTEGER) AS turbine_id, timestamp, wind_speed, wind_direction, power_output,
           TIMESTAMP '{AUDIT_TIME}' AS metadata_datetime_created
    FROM ({READINGS_SQL})
"""


def _typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_audit_column(readings(spark, sf_dir), at=_audit_time())


@query(INGESTED_SQL)
def ingestion_layer(spark, sf_dir):
    return unzoned(ingestion_layer_transform(raw_readings(spark, sf_dir), audit_time=_audit_time()))


@query(f"SELECT DISTINCT * FROM ({TYPED_SQL}) WHERE {VALID_SQL}")
def cleansed_layer(spark, sf_dir):
    return unzoned(cleansed_layer_transform(_typed(spark, sf_dir)))


@query(f"SELECT DISTINCT * FROM ({TYPED_SQL}) WHERE ({VALID_SQL}) IS NOT TRUE")
def quarantine_layer(spark, sf_dir):
    return unzoned(quarantine_layer_transform(_typed(spark, sf_dir)))


@query(
    f"""
    WITH valid AS (SELECT * FROM ({TYPED_SQL}) WHERE {VALID_SQL}),
         counts AS (SELECT (SELECT count(*) FROM ({TYPED_SQL})) AS seen,
                           (SELECT count(*) FROM valid) AS kept,
                           (SELECT count(*) FROM (SELECT DISTINCT * FROM valid)) AS unique_rows)
    SELECT 'filter' AS step, seen AS rows_in, seen - kept AS rows_removed, kept AS rows_out FROM counts
    UNION ALL
    SELECT 'deduplicate', kept, kept - unique_rows, unique_rows FROM counts
    """
)
def validation_statistics(spark, sf_dir):
    return cleansing_statistics(_typed(spark, sf_dir))


@query(f"SELECT DISTINCT * FROM ({READINGS_SQL})")
def dedupe_full_row(spark, sf_dir):
    return drop_duplicate_rows(readings(spark, sf_dir))


@query(
    """
    SELECT user_id, date, event_id, event_type, value FROM (
        SELECT *, CAST(ts AS DATE) AS date,
               row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) AS n
        FROM events)
    WHERE n = 1
    """
)
def dedupe_by_key(spark, sf_dir):
    """The latest event of each user and day."""
    rows = with_date(events(spark, sf_dir), "ts").select("user_id", "date", "ts", "event_id", "event_type", "value")
    return drop_duplicate_rows(rows, ["user_id", "date"], latest_by="ts").drop("ts")


@query(f"SELECT * FROM ({TYPED_SQL}) WHERE power_output IS NULL")
def audit_null_rows_query(spark, sf_dir):
    typed = cast_cleansed_schema(_typed(spark, sf_dir), READING_SCHEMA)
    return unzoned(audit_null_rows(typed, list(READING_SCHEMA)))


@query(
    f"""
    WITH r AS ({READINGS_SQL}),
         k AS (SELECT turbine_id, timestamp, count(*) - 1 AS surplus FROM r
               WHERE turbine_id IS NOT NULL AND timestamp IS NOT NULL GROUP BY turbine_id, timestamp)
    SELECT 'PRIMARY KEY' AS "constraint", 'turbine_id, timestamp' AS columns,
           CAST((SELECT sum(surplus) FROM k) AS BIGINT) AS violating_rows
    UNION ALL SELECT 'NOT NULL', 'turbine_id', (SELECT count(*) FROM r WHERE turbine_id IS NULL)
    UNION ALL SELECT 'NOT NULL', 'timestamp', (SELECT count(*) FROM r WHERE timestamp IS NULL)
    UNION ALL SELECT 'NOT NULL', 'power_output', (SELECT count(*) FROM r WHERE power_output IS NULL)
    """
)
def constraint_violations_query(spark, sf_dir):
    return constraint_violations(
        readings(spark, sf_dir), not_null=["power_output"], primary_key=["turbine_id", "timestamp"]
    )


def _surplus_sql(*names: str) -> str:
    whole = " AND ".join(f"{name} IS NOT NULL" for name in names)
    return f"""(SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT)
                FROM (SELECT count(*) AS n FROM r WHERE {whole} GROUP BY {", ".join(names)}))"""


@query(
    f"""
    WITH r AS ({TYPED_SQL})
    SELECT 'PRIMARY KEY' AS "constraint", 'turbine_id, timestamp' AS columns,
           {_surplus_sql("turbine_id", "timestamp")} AS violating_rows
    UNION ALL SELECT 'UNIQUE', 'turbine_id, wind_speed', {_surplus_sql("turbine_id", "wind_speed")}
    UNION ALL SELECT 'UNIQUE', 'power_output', {_surplus_sql("power_output")}
    UNION ALL SELECT 'NOT NULL', c, (SELECT count(*) FROM r WHERE turbine_id IS NULL OR timestamp IS NULL)
              FROM (VALUES ('turbine_id'), ('timestamp')) AS t(c)
    UNION ALL SELECT 'NOT NULL', 'metadata_datetime_created',
                     (SELECT count(*) FROM r WHERE metadata_datetime_created IS NULL)
    UNION ALL SELECT 'CHECK', 'wind_speed BETWEEN 0 AND 25',
                     (SELECT count(*) FROM r WHERE NOT (wind_speed BETWEEN 0 AND 25))
    UNION ALL SELECT 'CHECK', 'power_output >= 0 OR wind_direction < 90',
                     (SELECT count(*) FROM r WHERE NOT (power_output >= 0 OR wind_direction < 90))
    """
)
def declared_constraints(spark, sf_dir):
    """Constraints as a table definition spells them, several keys among them, in one scan."""
    declared = [
        "PRIMARY KEY (turbine_id, timestamp)",
        'CONSTRAINT one_speed UNIQUE ("turbine_id", wind_speed)',
        "UNIQUE (power_output)",
        "CHECK (wind_speed BETWEEN 0 AND 25)",
        "CONSTRAINT power CHECK (power_output >= 0 OR wind_direction < 90)",
    ]
    return declared_violations(_typed(spark, sf_dir), declared, READING_SCHEMA)


# ---------------------------------------------------------------- statistics and reports


@query(
    f"""
    SELECT turbine_id, CAST(timestamp AS DATE) AS date,
           round(avg(power_output), 6) AS mean_power_output,
           min(power_output) AS min_power_output, max(power_output) AS max_power_output
    FROM ({READINGS_SQL}) GROUP BY ALL
    """
)
def daily_stats(spark, sf_dir):
    daily = daily_statistics(readings(spark, sf_dir)).drop("stddev_power_output")
    return rounded(daily, "mean_power_output")


@query(
    """
    SELECT l_returnflag, CAST(l_shipdate AS DATE) AS date,
           round(stddev_pop(l_extendedprice), 4) AS stddev_l_extendedprice
    FROM lineitem GROUP BY ALL
    """
)
def daily_stddev(spark, sf_dir):
    """Three entities only: each holds about a third of all rows."""
    daily = daily_statistics(_table(spark, sf_dir, "lineitem"), "l_returnflag", "l_shipdate", "l_extendedprice")
    return rounded(daily.select("l_returnflag", "date", "stddev_l_extendedprice"), "stddev_l_extendedprice", digits=4)


@query(
    """
    SELECT o_orderstatus, CAST(o_orderdate AS DATE) AS date,
           round(avg(o_totalprice), 6) AS mean_o_totalprice,
           min(o_totalprice) AS min_o_totalprice,
           max(o_totalprice) AS max_o_totalprice,
           coalesce(max(o_totalprice) > avg(o_totalprice) + 2 * stddev_pop(o_totalprice)
                    OR min(o_totalprice) < avg(o_totalprice) - 2 * stddev_pop(o_totalprice), FALSE)
               AS anomalous_o_totalprice
    FROM orders GROUP BY ALL
    """
)
def curated_layer_hot_entities(spark, sf_dir):
    """The curated layer under other column names, with few entities of many rows each."""
    schema = {"date": "DATE", "anomalous_o_totalprice": "BOOLEAN"}
    curated = curated_layer_transform(
        _table(spark, sf_dir, "orders"), schema, "o_orderstatus", "o_orderdate", "o_totalprice"
    )
    return rounded(curated, "mean_o_totalprice")


def _min_max_sql(column: str) -> str:
    return f"""
    SELECT min({column}) AS min_{column}, max({column}) AS max_{column}
    FROM ({READINGS_SQL}) WHERE {VALID_SQL}
    """


def _valid_min_max(spark: SparkSession, sf_dir: str, column: str) -> DataFrame:
    rows = readings(spark, sf_dir)
    return min_max(keep_valid(rows, get_conditions(DEFAULT_RULES, rows)), column)


@query(_min_max_sql("wind_speed"))
def minmax_wind_speed(spark, sf_dir):
    return _valid_min_max(spark, sf_dir, "wind_speed")


@query(_min_max_sql("wind_direction"))
def minmax_wind_direction(spark, sf_dir):
    return _valid_min_max(spark, sf_dir, "wind_direction")


@query(_min_max_sql("power_output"))
def minmax_power_output(spark, sf_dir):
    return _valid_min_max(spark, sf_dir, "power_output")


@query(
    f"""
    SELECT turbine_id, count(date) AS anomalous_days
    FROM ({CURATED_EVENTS_SQL}) WHERE anomalous_power_output
    GROUP BY turbine_id ORDER BY anomalous_days DESC, turbine_id
    """
)
def anomalous_days_per_turbine(spark, sf_dir):
    return anomalous_days(curated_layer_transform(_event_readings(spark, sf_dir)))


@query("SELECT * FROM lineitem ORDER BY l_shipdate, l_orderkey, l_linenumber LIMIT 10")
def preview_first_rows(spark, sf_dir):
    return preview(_table(spark, sf_dir, "lineitem"), ["l_shipdate", "l_orderkey", "l_linenumber"])


@query(
    """
    SELECT * FROM (VALUES
        (1, 'doc_id', 'bigint', NULL, 64, 0),
        (2, 'text', 'string', (SELECT CAST(max(length(text)) AS INTEGER) FROM documents), NULL, NULL),
        (3, 'lang', 'string', (SELECT CAST(max(length(lang)) AS INTEGER) FROM documents), NULL, NULL),
        (4, 'source', 'string', (SELECT CAST(max(length(source)) AS INTEGER) FROM documents), NULL, NULL),
        (5, 'n_chars', 'bigint', NULL, 64, 0)
    ) AS t(position, column_name, data_type, character_maximum_length, numeric_precision, numeric_scale)
    """
)
def table_column_metadata_query(spark, sf_dir):
    return table_column_metadata(_table(spark, sf_dir, "documents"), measure_lengths=True)


# ---------------------------------------------------------------- the same reports as SQL over the layer tables


def _stored(spark: SparkSession, layer: str, rows: DataFrame) -> LayerTables:
    """Layer tables of which one has been written."""
    tables = parquet_tables(shared_folder(spark, "reports"))
    Writer.get_writer(getattr(tables, layer)).load(rows)
    return tables


@query(
    f"""
    WITH ingestion_table AS ({TYPED_SQL})
    SELECT * FROM ingestion_table
    WHERE timestamp IS NULL OR turbine_id IS NULL OR wind_speed IS NULL OR wind_direction IS NULL
       OR power_output IS NULL OR metadata_datetime_created IS NULL
    """
)
def sql_null_audit(spark, sf_dir):
    tables = _stored(spark, "ingestion", cast_cleansed_schema(_typed(spark, sf_dir), READING_SCHEMA))
    return unzoned(run_report(spark, tables, "null_audit"))


@query(
    f"""
    WITH cleansed_table AS (SELECT DISTINCT * FROM ({TYPED_SQL}) WHERE {VALID_SQL})
    SELECT min(wind_speed) AS min_wind_speed, max(wind_speed) AS max_wind_speed,
           min(wind_direction) AS min_wind_direction, max(wind_direction) AS max_wind_direction,
           min(power_output) AS min_power_output, max(power_output) AS max_power_output
    FROM cleansed_table
    """
)
def sql_min_max(spark, sf_dir):
    """The three reports of extremes over the whole table, side by side."""
    tables = _stored(spark, "cleansed", cleansed_layer_transform(_typed(spark, sf_dir)))
    names = ("min_max_wind_speed", "min_max_wind_direction", "min_max_power_output")
    reports = [run_report(spark, tables, name).withColumn("row", F.lit(1)) for name in names]
    return reports[0].join(reports[1], "row").join(reports[2], "row").drop("row")


@query(
    f"""
    SELECT turbine_id, count(date) AS anomalous_days FROM ({CURATED_EVENTS_SQL})
    WHERE anomalous_power_output = TRUE GROUP BY turbine_id ORDER BY anomalous_days DESC, turbine_id
    """
)
def sql_anomalous_days(spark, sf_dir):
    tables = _stored(spark, "curated", curated_layer_transform(_event_readings(spark, sf_dir)))
    return run_report(spark, tables, "anomalous_days")


# ---------------------------------------------------------------- from source to sink

PERIOD = {"filter_column": "timestamp", "start_date": "2024-01-03", "end_date": "2024-01-28"}
PERIOD_SQL = "CAST(timestamp AS DATE) BETWEEN DATE '2024-01-03' AND DATE '2024-01-28'"


@query(f"SELECT * FROM ({INGESTED_SQL}) WHERE {PERIOD_SQL}")
def etl_end_to_end(spark, sf_dir):
    """Delivered text files to the ingestion table, one period of them."""
    root = shared_folder(spark, "etl")
    raw_readings(spark, sf_dir).write.csv(f"{root}/raw", header=True)
    etl(
        spark,
        {"format": "csv", "read_options": {"path": f"{root}/raw", "header": "true", "mode": "PERMISSIVE"}},
        {"format": "parquet", "mode": "append", "write_options": {"path": f"{root}/ingestion"}},
        PERIOD,
        lambda rows: ingestion_layer_transform(rows, audit_time=_audit_time()),
    )
    return unzoned(_read(spark, f"{root}/ingestion"))


def _run(
    spark: SparkSession, sf_dir: str, layout: Callable[[str], LayerTables]
) -> tuple[LayerTables, DataFrame]:
    root = shared_folder(spark, "layers")
    raw_readings(spark, sf_dir).write.csv(f"{root}/raw", header=True)
    tables = layout(root)
    spec = {"format": "csv", "read_options": {"path": f"{root}/raw"}}
    return tables, run_layers(spark, spec, tables, date_filter=PERIOD, audit_time=_audit_time())


FLOW_SQL = f"""
    WITH ingestion AS (SELECT * FROM ({INGESTED_SQL}) WHERE {PERIOD_SQL}),
         cleansed AS (SELECT DISTINCT * FROM ingestion WHERE {VALID_SQL}),
         curated AS (
             SELECT turbine_id, CAST(timestamp AS DATE) AS date,
                    round(avg(power_output), 6) AS mean_power_output,
                    min(power_output) AS min_power_output,
                    max(power_output) AS max_power_output,
                    coalesce(max(power_output) > avg(power_output) + 2 * stddev_pop(power_output)
                             OR min(power_output) < avg(power_output) - 2 * stddev_pop(power_output), FALSE)
                        AS anomalous_power_output
             FROM cleansed GROUP BY ALL)
"""


@query(f"{FLOW_SQL} SELECT * FROM curated")
def full_flow(spark, sf_dir):
    """CSV files through all four layer tables; the curated table."""
    tables, _ = _run(spark, sf_dir, parquet_tables)
    return rounded(tables.read(spark, "curated"), "mean_power_output")


@query(
    f"""
    {FLOW_SQL},
         counts AS (SELECT (SELECT count(*) FROM ingestion) AS seen,
                           (SELECT count(*) FROM ingestion WHERE {VALID_SQL}) AS kept,
                           (SELECT count(*) FROM cleansed) AS unique_rows)
    SELECT 'filter' AS step, seen AS rows_in, seen - kept AS rows_removed, kept AS rows_out FROM counts
    UNION ALL
    SELECT 'deduplicate', kept, kept - unique_rows, unique_rows FROM counts
    """
)
def full_flow_statistics(spark, sf_dir):
    """CSV files through layer tables partitioned by day; what cleansing removed."""
    _, statistics = _run(spark, sf_dir, daily_parquet_tables)
    return statistics


# ---------------------------------------------------------------- repeated runs, deliveries and single layers


def _delivered(spark: SparkSession, sf_dir: str, broken: tuple[str, ...] = ()) -> DataFrame:
    """Raw readings whose power can't be read on the named days."""
    power = F.when(F.substring("timestamp", 1, 10).isin(*broken), "broken").otherwise(F.col("power_output"))
    return raw_readings(spark, sf_dir).withColumn("power_output", power)


_LAYER_COLUMNS = "timestamp, turbine_id, wind_speed, wind_direction, power_output"


@query(
    f"""
    WITH ingestion AS (
             SELECT * REPLACE (CASE WHEN CAST(timestamp AS DATE) = DATE '2024-01-13' THEN NULL ELSE power_output END
                               AS power_output)
             FROM ({INGESTED_SQL})),
         cleansed AS (SELECT DISTINCT * FROM ingestion WHERE {VALID_SQL}),
         quarantine AS (SELECT DISTINCT * FROM ingestion WHERE ({VALID_SQL}) IS NOT TRUE)
    SELECT 'cleansed' AS layer, {_LAYER_COLUMNS} FROM cleansed
    UNION ALL SELECT 'quarantine', {_LAYER_COLUMNS} FROM quarantine
    UNION ALL SELECT 'curated', CAST(CAST(timestamp AS DATE) AS TIMESTAMP), turbine_id, NULL, NULL, max(power_output)
    FROM cleansed GROUP BY turbine_id, CAST(timestamp AS DATE)
    """
)
def replace_period(spark, sf_dir):
    """Three days are delivered with broken power, then a period again: those corrected, another day broken."""
    root = shared_folder(spark, "replaced")
    tables = daily_parquet_tables(f"{root}/tables")
    again = {"start_date": "2024-01-09", "end_date": "2024-01-15"}
    versions = ((("2024-01-10", "2024-01-11", "2024-01-12"), None), (("2024-01-13",), again))
    for i, (broken, period) in enumerate(versions):
        _delivered(spark, sf_dir, broken).write.csv(f"{root}/raw{i}", header=True)
        spec = {"format": "csv", "read_options": {"path": f"{root}/raw{i}"}}
        run_layers(spark, spec, tables, date_filter=period, audit_time=_audit_time())
    columns = _LAYER_COLUMNS.split(", ")
    parts = [
        tables.read(spark, layer).select(F.lit(layer).alias("layer"), *columns) for layer in ("cleansed", "quarantine")
    ]
    curated = tables.read(spark, "curated").select(
        F.lit("curated").alias("layer"),
        F.col("date").cast("timestamp").alias("timestamp"),
        "turbine_id",
        F.lit(None).cast("double").alias("wind_speed"),
        F.lit(None).cast("int").alias("wind_direction"),
        F.col("max_power_output").alias("power_output"),
    )
    return unzoned(parts[0].unionByName(parts[1]).unionByName(curated))


# Days, hour of the run, and what each delivery adds to the power, so that versions differ.
DELIVERIES = (("2024-01-01", "2024-01-14", 1), ("2024-01-20", "2024-01-31", 3), ("2024-01-10", "2024-01-22", 2))


def _delivery_sql(first: str, last: str, number: int) -> str:
    return f"""
        SELECT * REPLACE (power_output + {number} AS power_output,
                          TIMESTAMP '2024-02-01 0{number}:00:00' AS metadata_datetime_created)
        FROM ({INGESTED_SQL}) WHERE timestamp IS NULL OR CAST(timestamp AS DATE) BETWEEN DATE '{first}' AND DATE '{last}'
    """


@query(
    f"""
    SELECT * FROM ({" UNION ALL ".join(_delivery_sql(*d) for d in DELIVERIES)})
    QUALIFY row_number() OVER (
        PARTITION BY turbine_id, timestamp,
                     CASE WHEN timestamp IS NULL THEN row(wind_speed, wind_direction, power_output) END
        ORDER BY metadata_datetime_created DESC, wind_speed DESC NULLS LAST, wind_direction DESC NULLS LAST,
                 power_output DESC NULLS LAST) = 1
    """
)
def merge_deliveries(spark, sf_dir):
    """Deliveries that overlap, the newest not last, merged one by one; rows without a time come in each."""
    tables = daily_parquet_tables(shared_folder(spark, "merged"))
    for first, last, number in DELIVERIES:
        typed = ingestion_layer_transform(
            raw_readings(spark, sf_dir), audit_time=F.lit(f"2024-02-01 0{number}:00:00").cast("timestamp")
        ).withColumn("power_output", F.col("power_output") + number)
        part = filter_ingestion_period(typed, "timestamp", first, last, keep_unparseable=True)
        merge_into(spark, part, tables, ["turbine_id", "timestamp"])
    return unzoned(tables.read(spark, "ingestion"))


def _period_run(spark: SparkSession, sf_dir: str, root: str) -> tuple[Flow, dict]:
    raw_readings(spark, sf_dir).write.csv(f"{root}/raw", header=True)
    schema = CURATED_SCHEMA | {"turbine_id": "BIGINT"}
    flow = Flow(parquet_tables(f"{root}/tables"), curated_schema=schema, audit_time=_audit_time())
    return flow, {"format": "csv", "read_options": {"path": f"{root}/raw"}}


@query(f"{FLOW_SQL} SELECT * REPLACE (CAST(turbine_id AS BIGINT) AS turbine_id) FROM curated")
def layer_by_layer(spark, sf_dir):
    """Each layer by itself; then a recorded run and the same again, which must find nothing left to do."""
    root = shared_folder(spark, "layer-by-layer")
    flow, raw = _period_run(spark, sf_dir, root)
    for layer in ("ingestion", "cleansed", "quarantine"):
        run_layer(spark, layer, flow, raw, PERIOD)
    run_layer(spark, "curated", flow, date_filter=PERIOD)
    alone = flow.tables.read(spark, "curated")
    again = Flow(parquet_tables(f"{root}/again"), curated_schema=flow.curated_schema, audit_time=_audit_time())
    for _ in range(2):
        run_flow(spark, again, raw, PERIOD, run_id="one")
    # Both ways give every row once; their averages differ in their last bits with the order of addition.
    mean, other = F.col("mean_power_output"), F.col("other_mean")
    second = again.tables.read(spark, "curated").withColumnRenamed("mean_power_output", "other_mean")
    both = alone.join(second, [name for name in alone.columns if name != "mean_power_output"])
    same = F.abs(mean - other) <= 1e-9 * F.greatest(F.abs(mean), F.abs(other))
    return rounded(both.where(same).select(*alone.columns), "mean_power_output")


@query(
    f"""
    {FLOW_SQL},
         counts AS (SELECT (SELECT count(*) FROM ({INGESTED_SQL})) AS delivered,
                           (SELECT count(*) FROM ({INGESTED_SQL}) WHERE timestamp IS NULL) AS unreadable,
                           (SELECT count(*) FROM ingestion) AS seen,
                           (SELECT count(*) FROM ingestion WHERE {VALID_SQL}) AS kept,
                           (SELECT count(*) FROM cleansed) AS unique_rows)
    SELECT 'outside_period' AS step, delivered AS rows_in, delivered - unreadable - seen AS rows_removed,
           seen + unreadable AS rows_out FROM counts
    UNION ALL SELECT 'unreadable_time', seen + unreadable, unreadable, seen FROM counts
    UNION ALL SELECT 'filter', seen, seen - kept, kept FROM counts
    UNION ALL SELECT 'deduplicate', kept, kept - unique_rows, unique_rows FROM counts
    """
)
def period_statistics(spark, sf_dir):
    """What the period, the rules and the de-duplication remove, counted while the layers are written."""
    flow, raw = _period_run(spark, sf_dir, shared_folder(spark, "period"))
    run = run_flow(spark, flow, raw, PERIOD)
    return run.period_statistics.unionByName(run.statistics)
