"""The physical plans: what reaches the scan, what is combined before a shuffle, what never appears."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from checks.queries import QUERIES
from checks.readings import events
from gustline.functions import get_conditions
from gustline.operators import (
    constraint_violations,
    daily_statistics,
    drop_duplicate_rows,
    filter_ingestion_period,
    keep_valid,
    validation_statistics,
)
from gustline.plans import cleansed_layer_transform, curated_layer_transform, ingestion_layer_transform

SF_DIR = "/root/testdata/sf0.001"
WRITING = ("sink_", "src_csv", "etl_", "full_flow", "replace_", "merge_", "layer_", "period_", "sql_")


def plan(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def test_period_reaches_the_scan_as_a_range(spark):
    text = plan(filter_ingestion_period(events(spark, SF_DIR), "ts", "2024-01-05", "2024-01-12"))
    assert "GreaterThanOrEqual(ts,2024-01-05T00:00)" in text and "LessThan(ts,2024-01-13T00:00)" in text


def test_rules_reach_the_scan(spark):
    rows = events(spark, SF_DIR).select("user_id", "value")
    text = plan(keep_valid(rows, get_conditions(["value BETWEEN 0 AND 25"], rows)))
    assert "GreaterThanOrEqual(value,0.0), LessThanOrEqual(value,25.0)" in text
    assert "ReadSchema: struct<user_id:bigint,value:double>" in text


def test_constraints_take_one_scan(spark):
    text = plan(constraint_violations(events(spark, SF_DIR), ["value"], ["user_id", "ts"]))
    assert text.count("ReadSchema") == 1 and "Union" not in text


def test_curated_reads_three_columns_and_shuffles_once(spark):
    text = plan(contract.queries()["curated_layer"](spark, SF_DIR))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,value:double>" in text
    assert text.count("Exchange (") == 1
    assert "partial_avg" in text and "partial_stddev_pop" in text


def test_duplicates_are_combined_before_the_shuffle(spark):
    for df in (
        drop_duplicate_rows(events(spark, SF_DIR)),
        drop_duplicate_rows(events(spark, SF_DIR), ["user_id"], latest_by="ts"),
    ):
        tree = plan(df).split("\n\n")[0]
        after, before = tree.split("Exchange", 1)
        assert "Aggregate" in after and "Aggregate" in before


def test_whole_chain_has_two_shuffles(spark):
    from checks.readings import raw_readings

    chain = curated_layer_transform(cleansed_layer_transform(ingestion_layer_transform(raw_readings(spark, SF_DIR))))
    tree = plan(chain).split("\n\n")[0]
    assert tree.count("Exchange") == 2


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith(WRITING)])
def test_no_python_cross_join_or_single_partition_shuffle_of_rows(spark, name):
    text = plan(contract.queries()[name](spark, SF_DIR))
    for unwanted in ("CartesianProduct", "NestedLoopJoin", "Python", "MapInArrow", "ArrowEvalPython"):
        assert unwanted not in text
    # A single partition only ever receives one partial record per task.
    for block in text.split("\n\n"):
        if "Arguments: SinglePartition" in block:
            number = int(block.strip().split(")")[0].lstrip("("))
            child = f"({number - 1}) HashAggregate"
            assert child in text


def shuffled_records(df):
    """Runs the query and counts the records its shuffles wrote."""
    df.collect()
    pending, total = [df._jdf.queryExecution().executedPlan()], 0
    while pending:
        node = pending.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            pending.append(node.executedPlan())
            continue
        if kind.endswith("QueryStageExec"):
            pending.append(node.plan())
            continue
        if kind == "ShuffleExchangeExec":
            total += node.metrics().apply("shuffleRecordsWritten").value()
        children = node.children()
        pending.extend(children.apply(i) for i in range(children.size()))
    return total


def test_hot_rows_send_one_record_per_task(spark):
    """A third of all rows are one copy, one turbine-day, or one invalid reading."""
    hot, tasks, n = F.col("id") % 3 == 0, 8, 80_000
    others = n - len(range(0, n, 3))
    rows = spark.range(0, n, 1, tasks).select(F.when(hot, -1).otherwise(F.col("id")).alias("v"))
    assert shuffled_records(drop_duplicate_rows(rows)) == others + tasks

    readings = spark.range(0, n, 1, tasks).select(
        F.when(hot, -1).otherwise(F.col("id")).alias("turbine_id"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("timestamp"),
        F.col("id").cast("double").alias("power_output"),
    )
    assert shuffled_records(daily_statistics(readings)) == others + tasks
    assert shuffled_records(drop_duplicate_rows(readings, ["turbine_id"])) == others + tasks
    keys = constraint_violations(readings, primary_key=["turbine_id", "timestamp"])
    assert shuffled_records(keys) <= others + tasks + 3 * tasks
    valid = validation_statistics(rows, F.expr("v >= 0"))
    assert shuffled_records(valid) <= others + tasks + tasks
