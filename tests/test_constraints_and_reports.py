"""Declared constraints in one scan, and the registry of reports."""

import datetime as dt
import itertools
import random

import pytest

from gustline.defaults import CURATED_SCHEMA, READING_SCHEMA
from gustline.functions import not_null_columns, spark_type_name
from gustline.operators import constraint_violations, declared_constraints, declared_violations
from gustline.plans import REPORTS, parquet_tables, register_report, run_report
from gustline.sinks import Writer
from tests.test_plans import plan, shuffled_records


@pytest.mark.parametrize(
    "text, expected",
    [
        ("PRIMARY KEY (id)", {"primary_key": ("id",)}),
        ("primary  key(a , b),", {"primary_key": ("a", "b")}),
        ('CONSTRAINT "my key" UNIQUE ("a ""b""", c)', {"unique": [('a "b"', "c")]}),
        ("UNIQUE NULLS NOT DISTINCT (a)", {"nulls_equal": [("a",)]}),
        ("UNIQUE NULLS DISTINCT (a)", {"unique": [("a",)]}),
        ("CONSTRAINT c CHECK ((a > 0) OR (b IN (1, 2)))", {"checks": ["(a > 0) OR (b IN (1, 2))"]}),
    ],
)
def test_table_constraints(text, expected):
    empty = {"not_null": [], "primary_key": (), "unique": [], "checks": [], "nulls_equal": []}
    assert declared_constraints([text]) == empty | expected


@pytest.mark.parametrize("text", ["FOREIGN KEY (a) REFERENCES t (b)", "UNIQUE (a + b)", "PRIMARY KEY ()", "EXCLUDE USING gist (a WITH =)", ""])
def test_what_cant_be_checked(text):
    with pytest.raises(ValueError):
        declared_constraints([text])


def test_column_constraints():
    schema = {"a": "INTEGER PRIMARY KEY", "b": "VARCHAR(10) UNIQUE NOT NULL", "c": "DOUBLE PRECISION"}
    found = declared_constraints([], schema)
    assert (found["primary_key"], found["unique"], found["not_null"]) == (("a",), [("b",)], ["b"])
    assert [spark_type_name(kind) for kind in schema.values()] == ["integer", "string", "double"]
    assert not_null_columns(schema) == ["b"]
    with pytest.raises(ValueError, match="one primary key"):
        declared_constraints(["PRIMARY KEY (b)"], schema)


def brute(rows, key, nulls_equal=False):
    seen, surplus = set(), 0
    for row in rows:
        value = tuple(row[i] for i in key)
        if nulls_equal or None not in value:
            surplus += value in seen
            seen.add(value)
    return surplus


def test_several_keys_equal_brute_force(spark):
    rng = random.Random(1)
    rows = [tuple(rng.choice([None, 0, 1, 2, 3]) for _ in range(4)) for _ in range(300)]
    df = spark.createDataFrame(rows, "a int, b int, `c d` int, e int")
    names = ["a", "b", "c d", "e"]
    for keys in itertools.combinations([(0,), (1, 0), (0, 1, 2), (2, 3), (0, 1, 2, 3)], 3):
        primary, first, second = (tuple(names[i] for i in key) for key in keys)
        found = constraint_violations(df, ["e"], primary, [first], ["a < b"], [second]).collect()
        expected = [("PRIMARY KEY", ", ".join(primary), brute(rows, keys[0])), ("UNIQUE", ", ".join(first), brute(rows, keys[1]))]
        expected.append(("UNIQUE", ", ".join(second), brute(rows, keys[2], nulls_equal=True)))
        required = list(dict.fromkeys([*primary, "e"]))
        expected += [("NOT NULL", name, sum(row[names.index(name)] is None for row in rows)) for name in required]
        expected.append(("CHECK", "a < b", sum(None not in row[:2] and not row[0] < row[1] for row in rows)))
        assert list(map(tuple, found)) == expected
    assert {r.violating_rows for r in constraint_violations(df.limit(0), [], ["a"], [["b"]], ["a < b"]).collect()} == {0}


def test_checks_alone_and_errors(spark):
    df = spark.createDataFrame([(1,), (None,), (-1,)], "a int")
    assert declared_violations(df, ["CHECK (a > 0)"]).collect() == [("CHECK", "a > 0", 1)]
    with pytest.raises(ValueError, match="No constraint"):
        constraint_violations(df)
    with pytest.raises(ValueError, match="missing"):
        declared_violations(df, ["UNIQUE (b)"])


def test_one_scan_and_few_records_for_hot_keys(spark, tmp_path):
    n, tasks = 20_000, 8
    spark.range(0, n, 1, tasks).selectExpr("if(id % 3 = 0, -1, id) AS a", "id % 2 AS b", "id AS c").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    report = declared_violations(df, ["PRIMARY KEY (a)", "UNIQUE (b)", "UNIQUE (a, b)", "CHECK (a >= 0)"])
    text = plan(report)
    assert text.count("ReadSchema") == 1 and "ReadSchema: struct<a:bigint,b:bigint>" in text
    distinct = n - len(range(0, n, 3))
    assert shuffled_records(report) <= 2 * distinct + 6 * tasks
    assert [r.violating_rows for r in report.collect()][0] == len(range(0, n, 3)) - 1


def tables_of(spark, tmp_path):
    tables = parquet_tables(str(tmp_path / "t"))
    curated = ", ".join(f"{name} {spark_type_name(kind)}" for name, kind in CURATED_SCHEMA.items())
    rows = [(1, dt.date(2024, 1, day), 1.0, 0.0, 2.0, day < 4) for day in range(1, 6)] + [(2, dt.date(2024, 1, 1), 1.0, 0.0, 2.0, True)]
    Writer.get_writer(tables.curated).load(spark.createDataFrame(rows, curated))
    readings = ", ".join(f"{name} {spark_type_name(kind)}" for name, kind in READING_SCHEMA.items())
    at = dt.datetime(2024, 1, 2, 12)
    Writer.get_writer(tables.ingestion).load(spark.createDataFrame([(at, 1, None, 90, 2.0, at), (at, 1, 5.0, 90, 2.0, at)], readings))
    return tables


def test_reports_take_parameters(spark, tmp_path):
    tables = tables_of(spark, tmp_path)
    assert run_report(spark, tables, "anomalous_days").collect() == [(1, 3), (2, 1)]
    some = run_report(spark, tables, "anomalous_days", first_day=dt.date(2024, 1, 2), last_day=dt.date(2024, 1, 9))
    assert some.collect() == [(1, 2)]
    assert run_report(spark, tables, "null_audit").count() == 1
    with pytest.raises(ValueError, match="no parameters"):
        run_report(spark, tables, "null_audit", first_day=1)
    with pytest.raises(ValueError, match="No report"):
        run_report(spark, tables, "weekly")


def test_reports_can_be_added(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("gustline.plans.reports.REPORTS", dict(REPORTS))
    register_report("by_turbine", "curated", "SELECT count(*) AS n FROM curated_table WHERE turbine_id = :turbine")
    tables = tables_of(spark, tmp_path)
    assert run_report(spark, tables, "by_turbine", turbine=2).collect() == [(1,)]
    with pytest.raises(Exception, match="(?i)parameter"):
        run_report(spark, tables, "by_turbine").collect()
    with pytest.raises(ValueError, match="already"):
        register_report("by_turbine", "curated", "SELECT 1")
