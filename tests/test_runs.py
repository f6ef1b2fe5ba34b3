"""Runs that replace and merge days, layers by themselves, counts of the period, zones, and headers of many files."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from gustline.defaults import CURATED_SCHEMA, RAW_COLUMNS
from gustline.operators import filter_ingestion_period
from gustline.plans import (
    Flow,
    daily_parquet_tables,
    etl,
    latest_versions,
    merge_deliveries,
    parquet_tables,
    run_flow,
    run_layer,
    run_layers,
)
from gustline.plans import runs as runs_module
from gustline.sources import Reader, csv_files, day_predicates, read_csv_directory

PERIOD = {"start_date": "2024-01-01", "end_date": "2024-01-03"}


def deliver(folder, rows, name="a.csv"):
    """Raw rows (day, hour, turbine, power) as a CSV folder."""
    folder.mkdir(exist_ok=True)
    lines = [f"2024-01-{day:02d} {hour:02d}:00:00,{turbine},10.0,90,{power}" for day, hour, turbine, power in rows]
    (folder / name).write_text("\n".join([",".join(RAW_COLUMNS), *lines]) + "\n")
    return {"format": "csv", "read_options": {"path": str(folder), "header": "true"}}


def held(spark, tables):
    """The days of each table."""
    names = {"ingestion": "day", "cleansed": "day", "quarantine": "day", "curated": "date"}
    folders = {name: tables.__getattribute__(name)["path"] for name in names}
    return {
        name: sorted(f.split("=")[1][-2:] for f in os.listdir(path) if "=" in f) if os.path.isdir(path) else []
        for name, path in folders.items()
    }


def test_corrected_and_emptied_days_leave_the_tables_they_no_longer_belong_to(spark, tmp_path):
    tables = daily_parquet_tables(str(tmp_path / "t"))
    first = [(1, 0, 1, "bad"), (2, 0, 1, 5), (3, 0, 1, 5), (3, 1, 1, "bad")]
    run_layers(spark, deliver(tmp_path / "raw1", first), tables, date_filter=PERIOD)
    assert held(spark, tables) == {"ingestion": ["01", "02", "03"], "cleansed": ["02", "03"], "quarantine": ["01", "03"], "curated": ["02", "03"]}
    second = [(1, 0, 1, 4), (2, 0, 1, "bad"), (3, 0, 1, 5), (3, 1, 1, "bad")]
    run_layers(spark, deliver(tmp_path / "raw2", second), tables, date_filter=PERIOD)
    assert held(spark, tables) == {"ingestion": ["01", "02", "03"], "cleansed": ["01", "03"], "quarantine": ["02", "03"], "curated": ["01", "03"]}
    # Days outside the period are nobody's business; days of it that aren't delivered stay unless asked otherwise.
    third = deliver(tmp_path / "raw3", [(1, 0, 1, "bad")])
    run_layers(spark, third, tables, date_filter={**PERIOD, "end_date": "2024-01-02"})
    assert held(spark, tables) == {"ingestion": ["01", "02", "03"], "cleansed": ["03"], "quarantine": ["01", "02", "03"], "curated": ["03"]}
    run_layers(spark, third, tables, date_filter={**PERIOD, "end_date": "2024-01-02"}, drop_absent_days=True)
    assert held(spark, tables) == {"ingestion": ["01", "03"], "cleansed": ["03"], "quarantine": ["01", "03"], "curated": ["03"]}
    assert tables.read(spark, "cleansed").count() == 1


def test_a_run_in_which_nothing_is_valid(spark, tmp_path):
    tables = daily_parquet_tables(str(tmp_path / "t"))
    run_layers(spark, deliver(tmp_path / "raw", [(1, 0, 1, "bad")]), tables, date_filter=PERIOD)
    assert held(spark, tables) == {"ingestion": ["01"], "cleansed": [], "quarantine": ["01"], "curated": []}
    run_layers(spark, deliver(tmp_path / "raw", [(1, 0, 1, 3)]), tables)
    run_layers(spark, deliver(tmp_path / "raw", [(1, 0, 1, "bad")]), tables)
    assert held(spark, tables) == {"ingestion": ["01"], "cleansed": [], "quarantine": ["01"], "curated": []}


def test_parts_of_days_dont_replace_days(spark, tmp_path):
    raw, tables = deliver(tmp_path / "raw", [(1, 0, 1, 5)]), daily_parquet_tables(str(tmp_path / "t"))
    deliver(tmp_path / "raw", [(1, 1, 1, 6)], "b.csv")
    run_layers(spark, raw, tables)
    assert tables.read(spark, "cleansed").count() == 2
    parts = [str(tmp_path / "raw" / "a.csv"), str(tmp_path / "raw" / "*.csv"), [str(tmp_path / "raw")]]
    for path in parts:
        with pytest.raises(ValueError, match="part of their files"):
            run_layers(spark, {"format": "csv", "read_options": {"path": path}}, tables)
    frame = read_csv_directory(spark, str(tmp_path / "raw" / "a.csv"))
    with pytest.raises(ValueError, match="whole_days"):
        run_layers(spark, frame, tables)
    assert tables.read(spark, "cleansed").count() == 2
    run_layers(spark, frame, tables, whole_days=True)
    assert tables.read(spark, "cleansed").count() == 1
    # Merged, a part of a day adds to it.
    run_layers(spark, {"format": "csv", "read_options": {"path": parts[1]}}, tables, merge_keys=["turbine_id", "timestamp"])
    assert tables.read(spark, "cleansed").count() == 2


KEYS = ["turbine_id", "timestamp"]


def at(hour):
    return F.lit(f"2024-02-01 {hour:02d}:00:00").cast("timestamp")


def test_overlapping_deliveries_in_any_order_equal_one_run_over_all(spark, tmp_path):
    parts = [
        [(1, h, 1, h) for h in range(10)] + [(2, 0, 2, "bad"), (2, 1, 2, 7)],
        [(2, h, 2, 20 + h) for h in range(5)] + [(3, 0, 1, 1)],
        [(1, h, 1, 50 + h) for h in range(5, 12)] + [(3, 0, 1, "bad")],
    ]
    expected = {}
    for hour, rows in enumerate(parts):
        expected |= {(day, h, turbine): (power, hour) for day, h, turbine, power in rows}
    for order in ((0, 1, 2), (2, 0, 1)):
        tables = daily_parquet_tables(str(tmp_path / f"t{order[0]}"))
        for i in order:
            raw = deliver(tmp_path / f"raw{i}", parts[i])
            run_layers(spark, raw, tables, merge_keys=KEYS, audit_time=at(i))
        rows = tables.read(spark, "ingestion").collect()
        found = {(r.timestamp.day, r.timestamp.hour, r.turbine_id): (r.power_output, r.metadata_datetime_created.hour) for r in rows}
        assert len(rows) == len(found)
        assert found == {k: (None if p == "bad" else float(p), h) for k, (p, h) in expected.items()}
        valid = {k for k, (p, _) in expected.items() if p != "bad"}
        assert {(r.timestamp.day, r.timestamp.hour, r.turbine_id) for r in tables.read(spark, "cleansed").collect()} == valid
        assert held(spark, tables)["quarantine"] == ["03"] and held(spark, tables)["curated"] == ["01", "02"]


def test_a_merge_reads_and_writes_the_touched_days_only(spark, tmp_path, monkeypatch):
    tables = daily_parquet_tables(str(tmp_path / "t"))
    run_layers(spark, deliver(tmp_path / "raw", [(d, 0, 1, d) for d in range(1, 20)]), tables)
    before = {f: os.listdir(tmp_path / "t" / "ingestion" / f) for f in os.listdir(tmp_path / "t" / "ingestion") if "=" in f}
    plans = []
    load = runs_module.Writer.load

    def watched(self, df, counted=None):
        plans.append(df._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")))
        load(self, df, counted)

    monkeypatch.setattr(runs_module.Writer, "load", watched)
    typed = tables.read(spark, "ingestion").where("day(timestamp) in (4, 7)").withColumn("metadata_datetime_created", at(9))
    days = merge_deliveries(spark, typed, tables, KEYS)
    assert sorted(d.day for d in days) == [4, 7]
    (text,) = plans
    assert "PartitionFilters: [day" in text and text.count("Exchange (") <= 2
    after = {f: os.listdir(tmp_path / "t" / "ingestion" / f) for f in before}
    assert sorted(f[-2:] for f in before if before[f] != after[f]) == ["04", "07"]
    assert merge_deliveries(spark, typed.limit(0), tables, KEYS) == []


def test_merges_need_the_event_time_and_replaced_days(spark, tmp_path):
    typed = spark.createDataFrame([], "timestamp timestamp, turbine_id int, metadata_datetime_created timestamp")
    with pytest.raises(ValueError, match="event time"):
        merge_deliveries(spark, typed, daily_parquet_tables(str(tmp_path)), ["turbine_id"])
    with pytest.raises(ValueError, match="replaced"):
        merge_deliveries(spark, typed, parquet_tables(str(tmp_path)), KEYS)


def test_rows_without_a_whole_key_are_no_versions_of_each_other(spark):
    rows = [(1, 5, 1, "a"), (1, 5, 2, "b"), (1, None, 1, "c"), (1, None, 2, "c"), (1, None, 3, "d"), (None, None, 1, None), (None, None, 2, None)]
    df = spark.createDataFrame(rows, "k int, t int, version int, v string")
    found = sorted(map(tuple, latest_versions(df, ["k", "t"], "version").collect()), key=repr)
    assert found == sorted([(1, 5, 2, "b"), (1, None, 2, "c"), (1, None, 3, "d"), (None, None, 2, None)], key=repr)


def test_a_failed_layer_is_run_alone_and_the_others_are_left(spark, tmp_path, monkeypatch):
    tables, raw = parquet_tables(str(tmp_path / "t")), deliver(tmp_path / "raw", [(1, h, 1, h) for h in range(8)])
    flow, curate = Flow(tables), runs_module.curated_layer_transform

    def broken(*args, **kwargs):
        raise RuntimeError("no curated layer today")

    monkeypatch.setattr(runs_module, "curated_layer_transform", broken)
    with pytest.raises(RuntimeError, match="today"):
        run_flow(spark, flow, raw, PERIOD, run_id="r1")
    monkeypatch.setattr(runs_module, "curated_layer_transform", curate)
    assert tables.read(spark, "ingestion").count() == 8
    run = run_flow(spark, flow, raw, PERIOD, run_id="r1")
    counts = {name: tables.read(spark, name).count() for name in ("ingestion", "cleansed", "quarantine", "curated")}
    assert counts == {"ingestion": 8, "cleansed": 8, "quarantine": 0, "curated": 1}
    assert run.layers["cleansed"].rows == 8 and run.statistics.collect() == [("filter", 8, 0, 8), ("deduplicate", 8, 0, 8)]
    assert run.period_statistics.collect()[0] == ("outside_period", 8, 0, 8)
    run_flow(spark, flow, raw, PERIOD, run_id="r1")
    assert tables.read(spark, "curated").count() == 1
    with pytest.raises(ValueError, match="another period"):
        run_flow(spark, flow, raw, {"end_date": "2024-01-02"}, run_id="r1")
    run_flow(spark, flow, raw, PERIOD, run_id="r2")
    assert tables.read(spark, "ingestion").count() == 16


def test_a_layer_is_run_again_if_what_it_is_made_from_was(spark, tmp_path, monkeypatch):
    tables, raw = daily_parquet_tables(str(tmp_path / "t")), deliver(tmp_path / "raw", [(1, 0, 1, 5)])
    done, run = [], runs_module.run_layer
    monkeypatch.setattr(runs_module, "run_layer", lambda s, layer, *a: done.append(layer) or run(s, layer, *a))
    monkeypatch.setattr(runs_module.RunRecord, "done", lambda self: {"curated": runs_module.LayerRun()})
    run_flow(spark, Flow(tables), raw, run_id="r")
    assert sorted(done) == ["cleansed", "curated", "ingestion", "quarantine"]


def test_single_layers_take_other_schemas_and_event_times(spark, tmp_path):
    tables = daily_parquet_tables(str(tmp_path / "t"), event_time="seen")
    schema = {"seen": "TIMESTAMP", "site": "INTEGER", "load": "DOUBLE PRECISION", "metadata_datetime_created": "TIMESTAMP NOT NULL"}
    curated = {"site": "BIGINT", "date": "DATE", "max_load": "REAL"}
    flow = Flow(tables, schema, curated, rules=["load >= 0"], entity="site", measure="load", whole_days=True)
    raw = spark.createDataFrame([("2024-01-01 00:00:00", "1", "2.5"), ("2024-01-02 00:00:00", "1", "-1")], "seen string, site string, load string")
    with pytest.raises(ValueError):
        run_layer(spark, "ingestion", flow)
    with pytest.raises(ValueError):
        run_layer(spark, "bronze", flow, raw)
    for layer in ("ingestion", "cleansed", "quarantine", "curated"):
        run_layer(spark, layer, flow, raw, {"start_date": "2024-01-01", "end_date": "2024-01-05"})
    assert dict(tables.read(spark, "curated").dtypes)["max_load"] == "float"
    assert [(r.site, r.max_load) for r in tables.read(spark, "curated").collect()] == [(1, 2.5)]
    assert [r.load for r in tables.read(spark, "quarantine").collect()] == [-1.0]
    again = run_layer(spark, "curated", flow, days=[dt.date(2024, 1, 1)])
    assert again.days == [dt.date(2024, 1, 1)] and tables.read(spark, "curated").count() == 1


@pytest.mark.parametrize("layout", [parquet_tables, daily_parquet_tables])
def test_what_the_period_removes_is_counted_by_the_write(spark, tmp_path, layout):
    rows = [(1, 0, 1, 5), (1, 1, 1, "bad"), (2, 0, 1, 5), (9, 0, 1, 5)]
    raw = deliver(tmp_path / "raw", rows)
    with open(tmp_path / "raw" / "a.csv", "a") as more:
        more.write("never,1,1,1,1\n,1,1,1,1\n")
    tables = layout(str(tmp_path / "t"))
    period = {"start_date": "2024-01-01", "end_date": "2024-01-02"}
    run = run_flow(spark, Flow(tables), raw, period)
    assert run.layers["ingestion"].period == {"delivered": 6, "outside": 1, "unreadable": 2}
    assert run.period_statistics.collect() == [("outside_period", 6, 1, 5), ("unreadable_time", 5, 2, 3)]
    kept = run_flow(spark, Flow(layout(str(tmp_path / "k"))), raw, {**period, "keep_unparseable": True})
    assert kept.period_statistics.collect()[1] == ("unreadable_time", 5, 0, 5)
    assert run_flow(spark, Flow(layout(str(tmp_path / "n"))), raw).period_statistics is None


def test_the_period_is_counted_in_the_scan_of_the_write(spark, tmp_path, monkeypatch):
    """The raw rows are computed once: an accumulator in them counts each row once."""
    seen = spark.sparkContext.accumulator(0)
    rows = spark.createDataFrame([(f"2024-01-0{d} 00:00:00", "1", "1", "1", "1") for d in range(1, 8)], ", ".join(f"{c} string" for c in RAW_COLUMNS))

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    raw = rows.mapInArrow(counted, rows.schema)
    run = run_layer(spark, "ingestion", Flow(parquet_tables(str(tmp_path))), raw, {"start_date": "2024-01-01", "end_date": "2024-01-03"})
    assert run.period["delivered"] == 7 == seen.value and run.rows == 3


def test_one_zone_for_a_set_of_tables(spark, tmp_path):
    """Sessions of different zones write and read the same days."""
    sessions = []
    for zone in ("America/Los_Angeles", "Asia/Tokyo"):
        session = spark.newSession()
        session.conf.set("spark.sql.session.timeZone", zone)
        session.conf.set("spark.sql.shuffle.partitions", "4")
        sessions.append(session)
    folder = tmp_path / "raw"
    folder.mkdir()
    times = ["2024-01-01 00:00:00", "2024-01-01 23:59:59", "2024-01-02T00:30:00+03:00", "2024-01-02 00:00", "2024-03-31 02:30:00", "2024-01-03", "later"]
    lines = [f"{t},1,5.0,90,{i}" for i, t in enumerate(times)]
    (folder / "a.csv").write_text("\n".join([",".join(RAW_COLUMNS), *lines]) + "\n")
    raw = {"format": "csv", "read_options": {"path": str(folder)}}
    results = []
    for i, session in enumerate(sessions):
        tables = daily_parquet_tables(str(tmp_path / f"t{i}"), zone="Europe/Berlin")
        run_layers(session, raw, tables, date_filter={"start_date": "2024-01-01", "end_date": "2024-12-31"})
        assert held(session, tables)["cleansed"] == held(session, tables)["curated"] == ["01", "02", "03", "31"]
        for reader in sessions:
            one = tables.readings(reader, "cleansed", {"start_date": "2024-01-01", "end_date": "2024-01-01"})
            found = sorted((r.p, r.m) for r in one.select(F.col("power_output").alias("p"), F.unix_micros("timestamp").alias("m")).collect())
            curated = sorted((r.date, r.max_power_output) for r in tables.read(reader, "curated").collect())
            # The day of unpartitioned rows, too, by range and by row.
            rows = tables.read(reader, "cleansed")
            by_range = filter_ingestion_period(rows, "timestamp", "2024-01-01", "2024-01-01", zone="Europe/Berlin")
            assert sorted(r.power_output for r in by_range.collect()) == [p for p, _ in found] == [0.0, 1.0, 2.0]
            results.append((found, curated))
    assert all(r == results[0] for r in results)
    assert results[0][0][0][1] == int(dt.datetime(2023, 12, 31, 23, tzinfo=dt.timezone.utc).timestamp() * 1_000_000)


def test_today_is_the_sessions_or_the_zones(spark):
    for zone, hours in (("Pacific/Kiritimati", 14), ("Etc/GMT+12", -12), ("+05:00", 5)):
        session = spark.newSession()
        session.conf.set("spark.sql.session.timeZone", zone)
        today = (dt.datetime.now(dt.timezone.utc) + dt.timedelta(hours=hours)).date()
        days = session.createDataFrame([(today + dt.timedelta(days=i),) for i in (-1, 0, 1)], "d date")
        assert [r.d for r in filter_ingestion_period(days, "d").collect()] == [today]
    zoned = filter_ingestion_period(days, "d", zone="Pacific/Kiritimati").collect()
    assert [r.d for r in zoned] in ([], [(dt.datetime.now(dt.timezone.utc) + dt.timedelta(hours=14)).date()])


def test_ten_thousand_files_of_two_headers(spark, tmp_path, monkeypatch):
    for i in range(10_000):
        text = f"a,b\n{i},x\n" if i % 5 else f"b,c,a\ny,1,{i}\n"
        (tmp_path / f"{i}.csv").write_text(text)
    opened, received = spark.sparkContext.accumulator(0), []
    frames = type(spark.range(1))
    reader, collect = csv_files._header_reader, frames.collect

    def counting(options):
        read = reader(options)

        def counted(batches):
            for batch in read(batches):
                opened.add(batch.num_rows)
                yield batch

        return counted

    def watched(self):
        rows = collect(self)
        received.append(len(rows))
        return rows

    monkeypatch.setattr(csv_files, "_header_reader", counting)
    monkeypatch.setattr(frames, "collect", watched)
    rows = read_csv_directory(spark, str(tmp_path))
    monkeypatch.setattr(frames, "collect", collect)
    summary = rows.agg(
        F.count("*"), F.sum(F.col("a").cast("long")), F.count_if(F.col("b") == "x"), F.count_if(F.col("b") == "y"), F.count("c")
    ).first()
    assert tuple(summary) == (10_000, sum(range(10_000)), 8_000, 2_000, 2_000)
    assert opened.value == 10_000 and max(received) == 2


def test_headers_that_cant_be_looked_at(spark, tmp_path, monkeypatch):
    (tmp_path / "a.csv").write_text("a,b\n1,2\n")
    monkeypatch.setattr(csv_files, "HEADER_SCHEMES", frozenset({"s3"}))
    with pytest.raises(ValueError, match="file://"):
        read_csv_directory(spark, str(tmp_path))
    spec = {"format": "csv", "columns": ["a", "b"], "read_options": {"path": str(tmp_path), "header": "true"}}
    assert Reader.get_reader(spec).extract(spark).collect() == [("1", "2")]
    etl(spark, spec, {"format": "parquet", "path": str(tmp_path / "out")})
    assert spark.read.parquet(str(tmp_path / "out")).collect() == [("1", "2")]
    (tmp_path / "raw").mkdir()
    deliver(tmp_path / "raw", [(1, 0, 1, 5)])
    tables = parquet_tables(str(tmp_path / "t"))
    run_layers(spark, {"format": "csv", "columns": RAW_COLUMNS, "read_options": {"path": str(tmp_path / "raw")}}, tables)
    assert tables.read(spark, "cleansed").count() == 1


def test_too_many_headers_and_strict_modes(spark, tmp_path, monkeypatch):
    (tmp_path / "a.csv").write_text("a,b\n1,2\n")
    (tmp_path / "b.csv").write_text("b,a,c\n2,1,3\n")
    with pytest.raises(ValueError, match="PERMISSIVE"):
        read_csv_directory(spark, str(tmp_path), options={"mode": "FAILFAST"})
    monkeypatch.setattr(csv_files, "MAX_HEADERS", 1)
    with pytest.raises(ValueError, match="different CSV headers"):
        read_csv_directory(spark, str(tmp_path))


@pytest.mark.parametrize("form", ["folder", "dotted", "glob", "list", "file"])
def test_every_form_of_path_binds_by_name(spark, tmp_path, form):
    folder = tmp_path / ("readings.2024" if form == "dotted" else "readings")
    folder.mkdir()
    (folder / "a.csv").write_text("turbine_id,power\n1,10\n")
    (folder / "b.csv").write_text("power,turbine_id\n20,2\n")
    (folder / "c.csv").write_text("power,turbine_id\n30,3\n")
    path = {"glob": f"{folder}/*.csv", "list": [f"{folder}/{n}.csv" for n in "abc"], "file": f"{folder}/b.csv"}.get(form, str(folder))
    source = {"format": "csv", "read_options": {"path": path, "header": "true", "mode": "PERMISSIVE"}}
    out = str(tmp_path / "out")
    etl(spark, source, {"format": "parquet", "path": out})
    found = {tuple(r) for r in spark.read.parquet(out).select("turbine_id", "power").collect()}
    assert found == ({("2", "20")} if form == "file" else {("1", "10"), ("2", "20"), ("3", "30")})


def test_jdbc_scans_are_split_by_day_or_take_one_task(spark):
    class Chain:
        def __init__(self):
            self.calls = []

        def __getattr__(self, name):
            return lambda *args, **kwargs: self.calls.append((name, args, kwargs)) or self

    days = day_predicates("timestamp", dt.date(2024, 2, 28), dt.date(2024, 3, 1), with_null=True)
    assert days[0] == "\"timestamp\" >= '2024-02-28' AND \"timestamp\" < '2024-02-29'" and len(days) == 4
    assert days[-1] == '"timestamp" IS NULL' and day_predicates('a"b', dt.date(2024, 1, 1), dt.date(2024, 1, 1))[0].startswith('"a""b" >=')
    with pytest.raises(ValueError):
        day_predicates("t", dt.date(2024, 1, 2), dt.date(2024, 1, 1))
    options = {"url": "jdbc:x", "dbtable": "t", "user": "u", "password": None, "fetchsize": 1000}
    session = type("S", (), {"read": Chain()})()
    Reader.get_reader({"format": "jdbc", "predicates": days, **options}).extract(session)
    assert session.read.calls == [("jdbc", ("jdbc:x", "t"), {"predicates": days, "properties": {"user": "u", "fetchsize": "1000"}})]
    session = type("S", (), {"read": Chain()})()
    Reader.get_reader({"format": "jdbc", **options}).extract(session)
    assert session.read.calls[1][2]["numPartitions"] == "1"
