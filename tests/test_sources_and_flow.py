"""Source and sink specs, CSV folders, and runs from files to tables."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from gustline.defaults import RAW_COLUMNS
from gustline.plans import LayerTables, daily_parquet_tables, etl, parquet_tables, run_layers, shared_folder
from gustline.sinks import Writer
from gustline.sources import (
    Reader,
    get_all_csv_files,
    get_postgresql_options,
    partitioned_read,
    read_csv_directory,
)


def write(path, text):
    path.write_text(text, encoding="utf-8")


@pytest.mark.parametrize(
    "spec, kind, options",
    [
        ({"options": {"path": "/data/file.csv"}}, "csv", {"path": "/data/file.csv"}),
        ({"path": "/data/v1.2/file.parquet"}, "parquet", {"path": "/data/v1.2/file.parquet"}),
        ({"format": "parquet", "options": {"path": "/d"}}, "parquet", {"path": "/d"}),
        (
            {"format": "csv", "read_options": {"path": "/a", "mode": "PERMISSIVE"}, "options": {"path": "/b"}},
            "csv",
            {"path": "/a", "mode": "PERMISSIVE"},
        ),
        (
            {"format": "jdbc", "mode": "append", "table": "t", "url": "u", "dbtable": "t"},
            "jdbc",
            {"url": "u", "dbtable": "t"},
        ),
        ({"format": "csv", "path": "/a", "mode": "failfast"}, "csv", {"path": "/a", "mode": "failfast"}),
    ],
)
def test_source_spec(spec, kind, options):
    reader = Reader.get_reader(spec)
    assert (reader.format, reader.options) == (kind, options)


@pytest.mark.parametrize(
    "spec", [{}, {"options": {"header": "true"}}, {"path": "/folder/file"}, {"format": "jdbc", "options": {"path": "x"}}]
)
def test_bad_source_spec(spec):
    with pytest.raises(ValueError):
        Reader.get_reader(spec)


def test_jdbc_source_checks_its_url_again(spark):
    with pytest.raises(ValueError):
        Reader("jdbc", {}).extract(spark)


def test_sink_spec():
    writer = Writer.get_writer({"format": "parquet", "write_options": {"path": "/o"}, "mode": "overwrite"})
    assert (writer.format, writer.options, writer.mode) == ("parquet", {"path": "/o"}, "overwrite")
    flat = Writer.get_writer({"format": "jdbc", "url": "u", "dbtable": "t", "table": "t", "batchsize": "5000"})
    assert (flat.options, flat.mode) == ({"url": "u", "dbtable": "t", "batchsize": "5000"}, "error")
    with pytest.raises(ValueError, match="No 'format' specified"):
        Writer.get_writer({"write_options": {"path": "/o"}})


class Chain:
    """Records the calls of a reader or writer chain."""

    def __init__(self):
        self.calls = []

    def __getattr__(self, name):
        def call(*args, **kwargs):
            self.calls.append((name, args, kwargs))
            return self

        return call


def test_jdbc_reaches_spark_as_options():
    connection = {"jdbc_url": "jdbc:postgresql://host:5432/", "user": "u", "password": "p"}
    options = get_postgresql_options("wind", "ingestion_table", connection)
    assert options == {
        "url": "jdbc:postgresql://host:5432/wind",
        "driver": "org.postgresql.Driver",
        "user": "u",
        "password": "p",
        "dbtable": "ingestion_table",
    }
    split = partitioned_read("timestamp", dt.date(2024, 1, 1), dt.date(2024, 2, 1), 31)
    session, frame = type("S", (), {"read": Chain()})(), type("D", (), {"write": Chain()})()
    Reader.get_reader({"format": "jdbc", "mode": "append", **options, **split}).extract(session)
    assert session.read.calls == [("format", ("jdbc",), {}), ("options", (), {**options, **split}), ("load", (), {})]
    assert split["lowerBound"] == "2024-01-01" and split["numPartitions"] == "31"
    Writer.get_writer({"format": "jdbc", "mode": "append", "table": "t", **options}).load(frame)
    assert frame.write.calls[1:] == [("options", (), options), ("mode", ("append",), {}), ("save", (), {})]


def test_jdbc_options_errors():
    with pytest.raises(ValueError):
        get_postgresql_options("d", "t", {"user": "u"})
    with pytest.warns(UserWarning, match="password"):
        get_postgresql_options("d", "t", {"jdbc_url": "jdbc:x/"})
    with pytest.raises(ValueError):
        partitioned_read("id", 0, 10, 0)


def test_options_without_a_value_are_left_out(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "t"))
    assert Reader("parquet", {"path": str(tmp_path / "t"), "mergeSchema": None}).extract(spark).count() == 3
    Writer("parquet", {"path": str(tmp_path / "u"), "compression": None}).load(spark.range(1))


def test_schema_is_enforced_and_drift_reported(spark, tmp_path):
    folder = str(tmp_path / "t.parquet")
    spark.sql("SELECT 1 AS a, 'x' AS b").write.parquet(folder)
    reader = Reader.get_reader({"path": folder, "schema": "a int, b string, c date"})
    assert reader.extract(spark).collect() == [(1, "x", None)]
    assert [r.status for r in reader.drift(spark).collect()] == ["match", "match", "missing"]
    with pytest.raises(ValueError):
        Reader.get_reader({"path": folder}).drift(spark)


def test_save_modes(spark, tmp_path):
    spec = {"format": "parquet", "path": str(tmp_path / "t")}
    one, two = spark.range(1), spark.range(2)
    count = lambda: Reader.get_reader(spec).extract(spark).count()
    Writer.get_writer(spec).load(one)
    with pytest.raises(Exception, match="(?i)exists"):
        Writer.get_writer(spec).load(two)
    for mode, rows in (("append", 3), ("ignore", 3), ("overwrite", 2)):
        Writer.get_writer({**spec, "mode": mode}).load(two)
        assert count() == rows


def test_partitioned_sink_writes_few_files(spark, tmp_path):
    rows = spark.range(0, 20_000, 1, 16).select("id", (F.col("id") % 4).alias("d"))
    spec = {"format": "parquet", "path": str(tmp_path / "t"), "partition_by": ["d"]}
    Writer.get_writer(spec).load(rows)
    files = [f for _, _, names in os.walk(tmp_path / "t") for f in names if f.endswith(".parquet")]
    assert len(files) == 4
    assert Reader.get_reader(spec).extract(spark).count() == 20_000


def test_csv_rows_of_odd_length(spark, tmp_path):
    write(tmp_path / "a.csv", "a,b,c\n1,2,3\n4\n5,6,7,8\n")
    assert read_csv_directory(spark, str(tmp_path)).collect() == [("1", "2", "3"), ("4", None, None), ("5", "6", "7")]


def test_csv_columns_bind_by_name(spark, tmp_path):
    write(tmp_path / "a.csv", "turbine_id,power\n1,10\n")
    write(tmp_path / "b.csv", '﻿power,"turbine_id"\r\n20,2\r\n')
    write(tmp_path / "c [1] d%20.csv", "power,turbine_id,note\n30,3,hi\n")
    write(tmp_path / "empty.csv", "")
    write(tmp_path / "readme.txt", "not a table")
    (tmp_path / "below").mkdir()
    write(tmp_path / "below" / "d.csv", "turbine_id,power\n9,90\n")
    rows = read_csv_directory(spark, str(tmp_path), required=["power"], file_column="file")
    assert sorted(rows.select("turbine_id", "power", "note").collect()) == [
        ("1", "10", None),
        ("2", "20", None),
        ("3", "30", "hi"),
    ]
    assert {r.turbine_id: r.file for r in rows.collect()}["1"] == "a.csv"
    assert get_all_csv_files(spark, str(tmp_path)).count() == 3
    with pytest.raises(ValueError, match="note"):
        read_csv_directory(spark, str(tmp_path), required=["note"])


def test_csv_with_one_declared_header_refuses_another(spark, tmp_path):
    write(tmp_path / "a.csv", "a,b\n1,2\n")
    assert read_csv_directory(spark, str(tmp_path), columns=["a", "b"]).collect() == [("1", "2")]
    assert read_csv_directory(spark, str(tmp_path), columns=["a", "b"]).select("b").collect() == [("2",)]
    write(tmp_path / "b.csv", "b,a\n4,3\n")
    with pytest.raises(Exception, match="CSV header does not conform|header"):
        read_csv_directory(spark, str(tmp_path), columns=["a", "b"]).collect()


def test_no_csv_files(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        get_all_csv_files(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError):
        read_csv_directory(spark, str(tmp_path / "nowhere"))


def test_etl(spark, tmp_path):
    write(tmp_path / "in.csv", "id,ingestion_date\n1,2023-01-01\n2,2023-01-02\n3,oops\n")
    source = {"read_options": {"path": str(tmp_path / "in.csv"), "header": "true", "mode": "PERMISSIVE"}}
    sink = {"format": "parquet", "path": str(tmp_path / "out"), "mode": "append"}
    etl(spark, source, sink, {"end_date": "2023-01-02"}, lambda df: df.select("id"))
    etl(spark, source, sink, transform=lambda df: df.select("id"))
    assert sorted(r.id for r in Reader.get_reader(sink).extract(spark).collect()) == ["1", "2", "2", "3"]
    with pytest.raises(ValueError):
        etl(spark, source, {"path": "x"})


def raw_folder(tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    first = [f"2024-01-01 {h:02d}:00:00,1,10.0,90,{p}" for h, p in enumerate([1, 1, 1, 1, 1, 1, 1, 50])]
    first += [first[0], "2024-01-01 09:00:00,1,99.0,90,2", "2024-01-02 00:00:00,1,10.0,90.9,3", "never,1,1,1,1"]
    write(folder / "data_group_1.csv", "\n".join([",".join(RAW_COLUMNS), *first]) + "\n")
    write(
        folder / "data_group_2.csv",
        "power_output,wind_direction,wind_speed,turbine_id,timestamp\n4,n/a,1,2,2024-01-01 00:00:00\n",
    )
    return {"format": "csv", "read_options": {"path": str(folder), "header": "true"}}


def test_all_layers(spark, tmp_path):
    tables = parquet_tables(str(tmp_path / "tables"))
    period = {"start_date": "2024-01-01", "end_date": "2024-01-01"}
    stats = run_layers(spark, raw_folder(tmp_path), tables, date_filter=period)
    tables.create_views(spark)
    assert spark.sql("SELECT max(wind_speed) FROM cleansed_table").first()[0] == 10.0
    assert spark.sql("SELECT count(*) FROM curated_table WHERE anomalous_power_output = TRUE").first()[0] == 1
    assert stats.collect() == [("filter", 11, 2, 9), ("deduplicate", 9, 1, 8)]
    assert tables.read(spark, "ingestion").count() == 11
    assert tables.read(spark, "cleansed").count() == 8
    assert sorted(r.power_output for r in tables.read(spark, "quarantine").collect()) == [2.0, 4.0]
    (curated,) = tables.read(spark, "curated").collect()
    assert (curated.turbine_id, curated.date, curated.max_power_output) == (1, dt.date(2024, 1, 1), 50.0)
    assert curated.anomalous_power_output is True


def test_all_layers_without_period_keep_unreadable_times(spark, tmp_path):
    tables = parquet_tables(str(tmp_path / "tables"))
    stats = run_layers(spark, raw_folder(tmp_path), tables, dynamic_conditions=["power_output < 40"])
    assert stats.collect() == [("filter", 13, 4, 9), ("deduplicate", 9, 1, 8)]
    assert tables.read(spark, "quarantine").filter("timestamp IS NULL").count() == 1
    assert tables.read(spark, "cleansed").filter("wind_direction = 90 AND power_output = 3").count() == 1


def test_running_again(spark, tmp_path):
    """Appending doubles the rows; key de-duplication with overwritten tables does not."""
    raw, period = raw_folder(tmp_path), {"start_date": "2024-01-01", "end_date": "2024-01-02"}
    appended = parquet_tables(str(tmp_path / "appended"))
    once = parquet_tables(str(tmp_path / "once"))
    replaced = LayerTables(
        once.ingestion, *({**spec, "mode": "overwrite"} for spec in (once.cleansed, once.quarantine, once.curated))
    )
    for run in range(2):
        at = F.lit(f"2024-02-0{run + 1} 00:00:00").cast("timestamp")
        plain = run_layers(spark, raw, appended, date_filter=period, audit_time=at)
        keyed = run_layers(
            spark, raw, replaced, date_filter=period, audit_time=at, dedupe_keys=["turbine_id", "timestamp"]
        )
    assert appended.read(spark, "cleansed").count() == 9 + 18
    assert plain.collect()[1] == ("deduplicate", 20, 2, 18)
    cleansed = replaced.read(spark, "cleansed")
    assert cleansed.count() == 9 and keyed.collect()[1] == ("deduplicate", 20, 11, 9)
    assert {str(r.metadata_datetime_created) for r in cleansed.collect()} == {"2024-02-02 00:00:00"}
    assert replaced.read(spark, "curated").count() == 2


def test_a_failing_layer_fails_the_run(spark, tmp_path):
    tables = parquet_tables(str(tmp_path / "tables"), mode="error")
    run_layers(spark, raw_folder(tmp_path), tables)
    again = LayerTables({**tables.ingestion, "mode": "append"}, tables.cleansed, tables.quarantine, tables.curated)
    with pytest.raises(Exception, match="(?i)exists"):
        run_layers(spark, {"path": str(tmp_path / "raw"), "format": "csv"}, again)


def test_statistics_where_the_sink_cannot_count(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("gustline.sinks.writer.FILE_FORMATS", frozenset())
    stats = run_layers(spark, raw_folder(tmp_path), parquet_tables(str(tmp_path / "tables")))
    assert stats.collect() == [("filter", 13, 3, 10), ("deduplicate", 10, 1, 9)]


@pytest.mark.parametrize("impossible", ["power_output > 1e9", "1 = 0"])
def test_nothing_valid(spark, tmp_path, impossible):
    tables = parquet_tables(str(tmp_path / "tables"))
    stats = run_layers(spark, raw_folder(tmp_path), tables, dynamic_conditions=[impossible])
    assert stats.collect() == [("filter", 13, 13, 0), ("deduplicate", 0, 0, 0)]
    assert tables.read(spark, "curated").count() == 0


def test_daily_tables_replace_their_days(spark, tmp_path):
    tables, raw = daily_parquet_tables(str(tmp_path / "tables")), raw_folder(tmp_path)
    both, second = ({"start_date": day, "end_date": "2024-01-02"} for day in ("2024-01-01", "2024-01-02"))
    for period, expected in ((both, (12, 2, 10, 9)), (both, (12, 2, 10, 9)), (second, (1, 0, 1, 1))):
        seen, removed, kept, unique = expected
        statistics = run_layers(spark, raw, tables, date_filter=period)
        assert statistics.collect() == [("filter", seen, removed, kept), ("deduplicate", kept, kept - unique, unique)]
        counts = [tables.read(spark, name).count() for name in ("ingestion", "cleansed", "quarantine", "curated")]
        assert counts == [12, 9, 2, 2]
    assert sorted(os.listdir(tmp_path / "tables" / "cleansed"))[-2:] == ["day=2024-01-01", "day=2024-01-02"]
    assert "day" not in tables.read(spark, "cleansed").columns


def test_daily_tables_read_only_the_days_of_the_period(spark, tmp_path):
    tables = daily_parquet_tables(str(tmp_path / "tables"))
    run_layers(spark, raw_folder(tmp_path), tables)
    assert tables.read(spark, "quarantine").filter("timestamp IS NULL").count() == 1
    rows = tables.readings(spark, "ingestion", {"start_date": "2024-01-02", "end_date": "2024-01-02"})
    assert rows.count() == 1
    partition_filter = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in partition_filter
    kept = tables.readings(spark, "ingestion", {"end_date": "2024-01-02", "keep_unparseable": True})
    assert kept.count() == 2


def test_csv_file_or_pattern(spark, tmp_path):
    for name in ("a1", "a2", "b1"):
        write(tmp_path / f"{name}.csv", f"id\n{name}\n")
    assert read_csv_directory(spark, str(tmp_path / "b1.csv")).collect() == [("b1",)]
    assert read_csv_directory(spark, str(tmp_path / "a*.csv")).count() == 2


def test_csv_options(spark, tmp_path):
    (tmp_path / "a.csv").write_text("naïve;b\n1;'2;3'\n", encoding="latin-1")
    (tmp_path / "b.csv").write_text("b;naïve\n4;5\n", encoding="latin-1")
    options = {"sep": ";", "quote": "'", "encoding": "iso-8859-1", "header": "true", "path": "ignored"}
    rows = read_csv_directory(spark, str(tmp_path), options=options)
    assert sorted(rows.select("naïve", "b").collect()) == [("1", "2;3"), ("5", "4")]
    with pytest.raises(ValueError):
        read_csv_directory(spark, str(tmp_path), options={"header": "false"})
    with pytest.raises(FileNotFoundError):
        read_csv_directory(spark, str(tmp_path), options={"modifiedAfter": "2999-01-01T00:00:00"})


def test_empty_raw_folder(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        run_layers(spark, {"format": "csv", "path": str(tmp_path)}, parquet_tables(str(tmp_path / "t")))


def test_shared_folder(spark):
    first, second = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert first != second and first.startswith(spark.conf.get("spark.checkpoint.dir"))

    class Cluster:
        class conf:
            @staticmethod
            def get(name, default=None):
                return {"spark.master": "yarn"}.get(name, default)

    with pytest.raises(RuntimeError):
        shared_folder(Cluster(), "x")


def test_replaced_days_need_all_their_files(spark, tmp_path):
    raw = {"format": "csv", "read_options": {"path": str(tmp_path), "modifiedAfter": "2024-01-01T00:00:00"}}
    with pytest.raises(ValueError, match="part of their files"):
        run_layers(spark, raw, daily_parquet_tables(str(tmp_path / "tables")))


def test_etl_binds_csv_columns_by_name(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    (folder / "a.csv").write_text("turbine_id,power\n1,10\n")
    (folder / "b.csv").write_text("power,turbine_id\n20,2\n")
    source = {"format": "csv", "read_options": {"path": str(folder), "header": "true"}}
    etl(spark, source, {"format": "parquet", "path": str(tmp_path / "out")})
    found = {tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).select("turbine_id", "power").collect()}
    assert found == {("1", "10"), ("2", "20")}


def test_columns_of_some_files_send_nothing_to_quarantine(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    head = "timestamp,turbine_id,wind_speed,wind_direction,power_output"
    (folder / "a.csv").write_text(f"{head},note\n2024-01-01 00:00:00,1,5.0,10,2.0,x\n")
    (folder / "b.csv").write_text(f"{head}\n2024-01-01 01:00:00,2,6.0,20,3.0\n")
    tables = parquet_tables(str(tmp_path / "tables"))
    run_layers(spark, {"format": "csv", "read_options": {"path": str(folder), "header": "true"}}, tables)
    assert {r.turbine_id for r in tables.read(spark, "cleansed").collect()} == {1, 2}
    assert tables.read(spark, "quarantine").count() == 0
