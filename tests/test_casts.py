"""Types and lenient casts."""

import datetime as dt
import math

import pytest
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gustline.functions import lenient_cast, not_null_columns, spark_type, spark_type_name
from gustline.operators import cast_cleansed_schema, cast_columns, cast_curated_schema, cast_ingestion_schema


def cast_text(spark, values, declared):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    typed = rows.select("i", lenient_cast(F.col("v"), T.StringType(), spark_type(declared)).alias("v"))
    return [row.v for row in sorted(typed.collect())]


@pytest.mark.parametrize(
    "declared, name",
    [
        ("INTEGER", "integer"),
        ("DOUBLE PRECISION", "double"),
        ("double  precision not null", "double"),
        ("TIMESTAMP", "timestamp"),
        ("TIMESTAMP WITHOUT TIME ZONE", "timestamp"),
        ("TIMESTAMP NOT NULL", "timestamp"),
        ("VARCHAR", "string"),
        ("varchar(20) NOT NULL", "string"),
        ("TEXT", "string"),
        ("BOOLEAN", "boolean"),
        ("BIGINT NOT NULL", "bigint"),
        ("FLOAT", "float"),
        ("DATE", "date"),
        ("NUMERIC(10,2)", "numeric(10,2)"),
    ],
)
def test_spark_spelling(spark, declared, name):
    assert spark_type_name(declared) == name
    assert spark_type(declared).typeName()


def test_unknown_type(spark):
    with pytest.raises(TypeError):
        spark_type("QUATERNION")


def test_not_null_columns():
    assert not_null_columns({"a": "TIMESTAMP NOT NULL", "b": "INTEGER", "c": "text not  null"}) == ["a", "c"]


def test_text_to_integer(spark):
    good = ["45", " 45 ", "45.7", ".5", "5.", "+3", "-0.9", "-7.99", "007", "2147483647", "\t8\n"]
    assert cast_text(spark, good, "INTEGER") == [45, 45, 45, 0, 5, 3, 0, -7, 7, 2147483647, 8]
    bad = ["abc", "", " ", "1e2", "9999999999", "2147483648.5", "1.2.3", "-", "+", "4 5", "1_000", "NaN", None]
    assert cast_text(spark, bad, "INTEGER") == [None] * len(bad)


def test_text_to_other_types(spark):
    doubles = cast_text(spark, ["1e2", "abc", "", "-0.5", "NaN", None], "DOUBLE PRECISION")
    assert doubles[:4] == [100.0, None, None, -0.5] and math.isnan(doubles[4]) and doubles[5] is None
    times = cast_text(spark, ["2024-1-1", "01/02/2024", "2024-13-01", "2024-01-01T05:06:07"], "TIMESTAMP")
    assert times == [dt.datetime(2024, 1, 1), None, None, dt.datetime(2024, 1, 1, 5, 6, 7)]
    assert cast_text(spark, ["t", "no", "2"], "BOOLEAN") == [True, False, None]


@settings(max_examples=15, deadline=None, phases=[Phase.generate], suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.text(alphabet="0123456789.+-eE \t\x00\x1f\x7fx٣dDfF", max_size=12)
        | st.sampled_from(["nan", " NaN", "-inf", "+Infinity", "infinity ", "n/a", "Info", "0x1p3", "\x7f1", "\u00a01"]),
        min_size=60,
        max_size=60,
    )
)
def test_text_to_numbers_like_a_session_without_ansi(spark, values):
    declared_types = ("SMALLINT", "INTEGER", "BIGINT", "DOUBLE PRECISION", "FLOAT", "NUMERIC(6,2)")
    ours = {declared: cast_text(spark, values, declared) for declared in declared_types}
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        for declared, cast in ours.items():
            plain = [r.v for r in sorted(rows.select("i", F.col("v").cast(spark_type(declared)).alias("v")).collect())]
            assert list(map(repr, cast)) == list(map(repr, plain)), declared
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_numbers_out_of_range_are_null(spark):
    rows = spark.createDataFrame([(45.7,), (-45.7,), (1e12,), (float("nan"),)], "v double")
    typed = cast_columns(rows, {"v": "INTEGER"})
    assert [row.v for row in typed.collect()] == [45, -45, None, None]


@pytest.mark.parametrize("target", ["TINYINT", "SMALLINT", "INTEGER", "BIGINT", "DECIMAL(3,2)", "DECIMAL(5,0)"])
def test_floats_become_what_try_cast_makes_of_them(spark, target):
    edges = [sign * (2.0**bits + offset) for bits in (7, 15, 31, 63) for sign in (1, -1) for offset in (-1, -0.5, 0, 0.5, 1)]
    edges += [9.99, 9.994, 9.995, 9.996, 10.0, -9.994, -9.995, -10.0, 99999.4, 99999.5, -0.0, 1e300]
    edges += [float("nan"), float("inf"), float("-inf")]
    rows = spark.createDataFrame([(v,) for v in edges], "v double")
    typed = spark_type(target)
    pairs = rows.select(lenient_cast(F.col("v"), T.DoubleType(), typed), F.col("v").try_cast(typed)).collect()
    assert [ours for ours, _ in pairs] == [plain for _, plain in pairs]


RAW = "turbine_id long, timestamp string, power_output double"
RAW_ROWS = [
    (1, "2024-01-01 00:00:00", 100.0),
    (2, "2024-01-01 01:00:00", 120.5),
    (3, "2024-01-01 02:00:00", 140.3),
    (4, "2024-01-01 03:00:00", 160.8),
]
SCHEMA = {
    "turbine_id": "INTEGER",
    "timestamp": "TIMESTAMP WITHOUT TIME ZONE",
    "power_output": "DOUBLE PRECISION",
    "metadata_datetime_created": "TIMESTAMP",
}


def test_ingestion_cast(spark):
    raw = spark.createDataFrame(RAW_ROWS, RAW)
    typed = cast_ingestion_schema(raw, SCHEMA, skip_columns=["metadata_datetime_created"])
    assert typed.dtypes == [("turbine_id", "int"), ("timestamp", "timestamp"), ("power_output", "double")]
    assert typed.collect()[3] == (4, dt.datetime(2024, 1, 1, 3), 160.8)
    assert cast_ingestion_schema(typed, SCHEMA, ["metadata_datetime_created"]).collect() == typed.collect()


def test_missing_columns_are_all_named(spark):
    raw = spark.createDataFrame(RAW_ROWS, RAW).drop("power_output", "turbine_id")
    with pytest.raises(ValueError, match="turbine_id.*power_output"):
        cast_ingestion_schema(raw, SCHEMA, ["metadata_datetime_created"])
    with pytest.raises(ValueError, match="metadata_datetime_created"):
        cast_ingestion_schema(spark.createDataFrame(RAW_ROWS, RAW), SCHEMA)
    with pytest.raises(ValueError):
        cast_curated_schema(raw, {"anomalous_power_output": "BOOLEAN"})
    with pytest.raises(ValueError):
        cast_cleansed_schema(raw, SCHEMA)


def test_cleansed_cast_wants_a_mapping(spark):
    with pytest.raises(TypeError):
        cast_cleansed_schema(spark.range(1), ["id"])


def test_impossible_cast_is_a_type_error(spark):
    with pytest.raises(TypeError):
        cast_columns(spark.sql("SELECT array(1) AS a"), {"a": "INTEGER"})


def test_other_columns_and_order_stay_unless_projected(spark):
    rows = spark.sql("SELECT 'x' AS extra, '1' AS b, '2.5' AS `a.b`")
    schema = {"a.b": "DOUBLE PRECISION", "b": "INTEGER"}
    assert cast_columns(rows, schema).collect() == [("x", 1, 2.5)]
    assert cast_columns(rows, schema, project=True).columns == ["a.b", "b"]


@pytest.mark.parametrize(
    ("declared", "name"),
    [
        ("INT4 NOT NULL", "int"),
        ("INT8", "bigint"),
        ("FLOAT8 NULL", "double"),
        ("CHAR(3)", "string"),
        ("CHARACTER VARYING(20) NOT NULL", "string"),
        ("TIMESTAMPTZ(3)", "timestamp"),
        ("TIMESTAMP WITH TIME ZONE", "timestamp"),
        ("TIMESTAMP(6) WITHOUT TIME ZONE NOT NULL", "timestamp"),
    ],
)
def test_postgresql_spellings(spark, declared, name):
    assert spark_type_name(declared) == name
    assert spark_type(declared).simpleString() == name
