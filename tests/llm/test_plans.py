"""The physical plans of the training-data queries, and executors that have no copy of the package."""

import os
import subprocess
import sys

import pytest

from gustline.llm import queries

SMALL = "/root/testdata/sf0.001"
REPOSITORY = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
NATIVE = ("op4_decontamination",)


def plan(df):
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_no_cross_join_and_no_rows_into_one_partition(spark, name):
    text = plan(queries.QUERIES[name](spark, SMALL))
    for unwanted in ("CartesianProduct", "NestedLoopJoin", "SinglePartition"):
        assert unwanted not in text
    if name in NATIVE:
        for unwanted in ("Python", "MapInArrow", "ArrowEval"):
            assert unwanted not in text


SCRIPT = """
import sys
sys.path.insert(0, {repository!r})
from pyspark.sql import SparkSession
spark = (
    SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
    .config("spark.sql.shuffle.partitions", "2").config("spark.checkpoint.dir", {folder!r}).getOrCreate()
)
from gustline.llm import queries
for name in {names!r}:
    print(name, queries.QUERIES[name](spark, {data!r}).count())
print("all run")
"""


def test_executors_need_no_copy_of_the_package(tmp_path):
    """From an empty folder, with a path that only the driver has."""
    names = list(queries.QUERIES)
    code = SCRIPT.format(repository=REPOSITORY, folder=str(tmp_path / "shared"), names=names, data=SMALL)
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    (tmp_path / "empty").mkdir()
    done = subprocess.run(
        [sys.executable, "-c", code], cwd=tmp_path / "empty", env=environment, capture_output=True, text=True, timeout=600
    )
    assert "all run" in done.stdout, done.stdout + done.stderr[-3000:]
