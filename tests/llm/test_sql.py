"""The queries that SQL can express, over whole tables."""

import duckdb
import pytest

from gustline.llm import queries
from tests.llm.conftest import SF_DIR


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for table in "documents benchmark embeddings conversations".split():
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    found = queries.QUERIES[name](spark, SF_DIR)
    expected = duck.sql(queries.ORACLES[name])
    assert sorted(found.columns) == sorted(expected.columns)
    ours = sorted(map(tuple, found.select(*expected.columns).collect()))
    assert ours and ours == sorted(expected.fetchall())
