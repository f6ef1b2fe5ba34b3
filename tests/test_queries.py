"""What the queries themselves do beside their operators."""

import datetime as dt

import duckdb
from pyspark.sql import functions as F

from checks.queries import ORACLES, QUERIES
from gustline.plans import LayerTables
from gustline.sources import Reader

SF_DIR = "/root/testdata/sf0.001"


def test_rows_of_both_ways_are_told_alike_whatever_the_order_of_addition(spark, monkeypatch):
    read = LayerTables.read

    def last_bits_differ(tables, session, layer, *more):
        rows = read(tables, session, layer, *more)
        again = "/again/" in Reader.get_reader(getattr(tables, layer)).options["path"]
        if layer != "curated" or not again:
            return rows
        return rows.withColumn("mean_power_output", F.col("mean_power_output") * F.lit(1 + 2**-51))

    monkeypatch.setattr(LayerTables, "read", last_bits_differ)
    frame = QUERIES["layer_by_layer"](spark, SF_DIR)
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW events AS SELECT * FROM '{SF_DIR}/events.parquet'")
    names = ", ".join(frame.columns)
    expected = connection.sql(f"SELECT {names} FROM ({ORACLES['layer_by_layer']})").fetchall()
    assert expected and sorted(map(tuple, frame.collect())) == sorted(expected)


def test_extremes_are_those_of_the_whole_table(spark, tmp_path):
    """The smallest and largest values lie outside the two weeks in the middle of the month."""
    days = {1: 5.0, 10: 40.0, 15: 50.0, 30: 900.0, 31: 70.0}
    rows = [(100 + i, dt.datetime(2024, 1, day, 12), 1, value) for i, (day, value) in enumerate(days.items())]
    rows.append((200, dt.datetime(9999, 12, 31, 23), 1, 2000.0))
    schema = "event_id long, ts timestamp_ntz, user_id long, value double"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/events.parquet")
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    frame = QUERIES["sql_min_max"](spark, str(tmp_path))
    names = ", ".join(frame.columns)
    ours = frame.collect()
    assert (ours[0].min_power_output, ours[0].max_power_output) == (5.0, 2000.0)
    assert [tuple(row) for row in ours] == connection.sql(f"SELECT {names} FROM ({ORACLES['sql_min_max']})").fetchall()
