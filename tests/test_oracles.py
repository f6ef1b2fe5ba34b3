"""Every registered query against its SQL, over whole tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as contract
from checks.queries import ORACLES as OWN_SQL
from checks.queries import QUERIES as OWN

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="session")
def duck():
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


# The type each side reports for the same column.
SAME_TYPE = {
    "bigint": {"BIGINT"},
    "int": {"INTEGER"},
    "double": {"DOUBLE"},
    "string": {"VARCHAR"},
    "boolean": {"BOOLEAN"},
    "date": {"DATE"},
    "timestamp_ntz": {"TIMESTAMP"},
}


def comparable(rows):
    def value(x):
        return "NaN" if isinstance(x, float) and math.isnan(x) else x

    return sorted((tuple(map(value, row)) for row in rows), key=repr)


def test_every_query_has_an_oracle():
    assert OWN.keys() == OWN_SQL.keys()
    assert contract.queries().keys() >= contract.oracle_sql().keys() >= OWN_SQL.keys()


@pytest.mark.parametrize("name", list(contract.oracle_sql()))
def test_query_equals_oracle(spark, duck, name):
    frame = contract.queries()[name](spark, SF_DIR)
    expected = duck.sql(contract.oracle_sql()[name])
    names = sorted(frame.columns)
    assert names == sorted(expected.columns)
    theirs = dict(zip(expected.columns, map(str, expected.types)))
    for column, kind in frame.dtypes:
        assert theirs[column] in SAME_TYPE[kind], column
    quoted = ", ".join(f'"{column}"' for column in names)
    ours = comparable(frame.select(*names).collect())
    assert ours, "an empty result checks nothing"
    assert ours == comparable(duck.sql(f"SELECT {quoted} FROM ({contract.oracle_sql()[name]})").fetchall())
