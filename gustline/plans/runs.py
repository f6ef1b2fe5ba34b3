"""The layers one by one, or all of them, with a record of what has been done."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from threading import Lock
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gustline.defaults import AUDIT, CURATED_SCHEMA, DEFAULT_RULES, ENTITY, MEASURE, READING_SCHEMA
from gustline.functions import get_conditions
from gustline.operators import cast_cleansed_schema, day_of, keep_invalid, keep_valid, period_days, period_metrics
from gustline.plans.layers import (
    cleansed_layer_transform,
    cleansing_statistics,
    curated_layer_transform,
    ingestion_layer_transform,
    quarantine_layer_transform,
)
from gustline.plans.merge import merge_deliveries
from gustline.plans.tables import LAYERS, Days, LayerTables, Spec, nothing_written, within_period
from gustline.sinks import Writer
from gustline.sources import Reader, is_directory, read_csv_directory

# What each layer is made from.
SOURCE = {"ingestion": None, "cleansed": "ingestion", "quarantine": "ingestion", "curated": "cleansed"}


@dataclass(frozen=True)
class Flow:
    """What the layers are made by, beside their tables.

    ``dedupe_keys``: the cleansed layer takes the latest ingested version of a reading. ``merge_keys``:
    the ingestion layer itself holds each reading once, see ``merge_deliveries``; a run then
    may deliver parts of days. ``drop_absent_days``: days of the period that aren't delivered
    any more leave the ingestion table, and with it all others. ``whole_days``: the caller vouches
    that a frame, a single file or a glob holds whole days.
    """

    tables: LayerTables
    schema: Mapping[str, str] = field(default_factory=lambda: READING_SCHEMA)
    curated_schema: Mapping[str, str] = field(default_factory=lambda: CURATED_SCHEMA)
    rules: Sequence[str] = tuple(DEFAULT_RULES)
    dynamic_conditions: Sequence[str] = ()
    dedupe_keys: Sequence[str] | None = None
    merge_keys: Sequence[str] | None = None
    entity: str = ENTITY
    measure: str = MEASURE
    audit: str = AUDIT
    audit_time: Column | None = None
    drop_absent_days: bool = False
    whole_days: bool = False

    def condition(self, typed: DataFrame) -> Column:
        return get_conditions(self.rules, typed, dynamic_conditions=self.dynamic_conditions)


@dataclass(frozen=True)
class LayerRun:
    """What running a layer did: rows written (if its sink can tell), days it had to do with, period counts."""

    rows: int | None = None
    days: Days | None = None
    period: Mapping[str, int] | None = None


# Source options by which a scan sees a part of the files only.
PARTIAL_SCAN_OPTIONS = ("modifiedAfter", "modifiedBefore", "pathGlobFilter")


def _refuse_partial_days(spark: SparkSession, raw: Spec | DataFrame, flow: Flow) -> None:
    """``ValueError`` where a run would replace whole days by the readings of some of their files."""
    if flow.merge_keys or flow.whole_days or not flow.tables.replaces_days("ingestion"):
        return
    if isinstance(raw, DataFrame):
        raise ValueError("Days would be replaced by a frame that may hold a part of them: state whole_days=True")
    reader = Reader.get_reader(raw)
    options = {key.lower() for key, value in reader.options.items() if value is not None}
    partial = [name for name in PARTIAL_SCAN_OPTIONS if name.lower() in options]
    if partial:
        raise ValueError(f"Days would be replaced by a part of their files: {partial}")
    path = reader.options.get("path")
    if path is not None and not (isinstance(path, str) and is_directory(spark, path)):
        raise ValueError(f"Days would be replaced by a part of their files ({path}): name a folder or state whole_days=True")


def _raw_rows(spark: SparkSession, raw: Spec | DataFrame, flow: Flow) -> DataFrame:
    if isinstance(raw, DataFrame):
        return raw
    reader = Reader.get_reader(raw)
    if reader.format != "csv":
        return reader.extract(spark)
    required = [name for name in flow.schema if name != flow.audit]
    return read_csv_directory(
        spark, reader.options["path"], required, reader.columns, options=reader.options, only_common=True
    )


def _ingest(spark: SparkSession, flow: Flow, raw: Spec | DataFrame, date_filter: Spec | None) -> LayerRun:
    tables, sink = flow.tables, Writer.get_writer(flow.tables.ingestion)
    _refuse_partial_days(spark, raw, flow)
    rows = _raw_rows(spark, raw, flow)
    # Metrics come with the write. In mode "ignore" nothing may be written, so nothing would be counted.
    counting = (sink.counts and sink.mode != "ignore") or flow.merge_keys
    seen, written = Observation(), Observation()
    if date_filter:
        date_filter = {"filter_column": tables.event_time, "zone": tables.zone, **date_filter}
        if counting:
            metrics = period_metrics(rows, date_filter)
            rows = rows.observe(seen, *(metric.alias(name) for name, metric in metrics.items()))
    delivered = within_period(rows, date_filter, tables.event_time, tables.zone)
    typed = ingestion_layer_transform(delivered, dict(flow.schema), flow.audit, flow.audit_time, tables.zone)
    days = None
    if flow.merge_keys:
        days = merge_deliveries(spark, typed, tables, flow.merge_keys, flow.audit)
    else:
        tables.write_readings("ingestion", typed, written if counting else None)
        if flow.drop_absent_days and date_filter:
            present = delivered.select(day_of(delivered, tables.event_time, tables.zone).alias("day")).distinct()
            tables.drop_days_without(spark, "ingestion", present, date_filter, None)
    period = dict(seen.get) if date_filter and counting else None
    return LayerRun(written.get["rows"] if counting and not flow.merge_keys else None, days, period)


def _split(spark: SparkSession, flow: Flow, layer: str, date_filter: Spec | None, days: Days | None) -> LayerRun:
    tables, schema = flow.tables, dict(flow.schema)
    ingested = tables.readings(spark, "ingestion", date_filter, days)
    typed = cast_cleansed_schema(ingested, schema)
    if layer == "cleansed":
        latest_by = flow.audit if flow.dedupe_keys else None
        rows = cleansed_layer_transform(
            ingested, schema, flow.dynamic_conditions, flow.rules, flow.dedupe_keys, latest_by
        )
        source = keep_valid(typed, flow.condition(typed))
    else:
        rows = quarantine_layer_transform(ingested, schema, flow.dynamic_conditions, flow.rules)
        source = keep_invalid(typed, flow.condition(typed))
    sink, written = Writer.get_writer(getattr(tables, layer)), Observation()
    counting = sink.counts and sink.mode != "ignore"
    tables.write_readings(layer, rows, written if counting else None)
    present = source.select(day_of(source, tables.event_time, tables.zone).alias("day")).distinct()
    tables.drop_days_without(spark, layer, present, date_filter, days)
    return LayerRun(written.get["rows"] if counting else None, days)


def _curate(spark: SparkSession, flow: Flow, date_filter: Spec | None, days: Days | None) -> LayerRun:
    tables = flow.tables
    expected = cast_cleansed_schema(tables.read(spark, "ingestion"), dict(flow.schema)).schema
    cleansed = tables.readings(spark, "cleansed", date_filter, days, expected)
    rows = curated_layer_transform(
        cleansed, dict(flow.curated_schema), flow.entity, tables.event_time, flow.measure, tables.zone
    )
    Writer.get_writer(tables.curated).load(rows)
    if tables.replaces_days("curated"):
        tables.drop_days_without(spark, "curated", tables.days(spark, "cleansed", date_filter, days), date_filter, days)
    return LayerRun(None, days)


def run_layer(
    spark: SparkSession,
    layer: str,
    flow: Flow,
    raw: Spec | DataFrame | None = None,
    date_filter: Spec | None = None,
    days: Days | None = None,
) -> LayerRun:
    """One layer by itself, from the table it is made from (ingestion: from ``raw``).

    ``date_filter`` or ``days`` choose the period. In tables whose days are replaced, a day of the period
    for which the layer gets no row any more leaves its table.
    """
    if layer not in SOURCE:
        raise ValueError(f"No layer {layer!r}: one of {list(SOURCE)}")
    if layer == "ingestion":
        if raw is None:
            raise ValueError("The ingestion layer needs raw readings")
        return _ingest(spark, flow, raw, date_filter)
    if layer == "curated":
        return _curate(spark, flow, date_filter, days)
    return _split(spark, flow, layer, date_filter, days)


RUN_SCHEMA = (
    "run_id string, layer string, finished timestamp, first_day date, last_day date, days array<date>, "
    "rows_written long, delivered long, outside long, unreadable long"
)


class RunRecord:
    """What the run of one id has done so far, in the table ``runs``."""

    def __init__(self, spark: SparkSession, tables: LayerTables, run_id: str, date_filter: Spec | None):
        if tables.runs is None:
            raise ValueError("These tables name no table for the records of runs")
        self.spark, self.tables, self.run_id = spark, tables, run_id
        self.one_at_a_time = Lock()  # a folder takes one append at a time
        self.period: tuple[Any, Any] = (None, None)
        if date_filter:
            names = ("start_date", "end_date", "today")
            chosen = {name: date_filter.get(name) for name in names}
            self.period = period_days(spark, **chosen, zone=date_filter.get("zone", tables.zone))

    def done(self) -> dict[str, LayerRun]:
        """``ValueError`` if the id belongs to a run of another period."""
        try:
            rows = Reader.get_reader({**self.tables.runs, "schema": RUN_SCHEMA}).extract(self.spark)
            records = rows.filter(F.col("run_id") == self.run_id).collect()
        except AnalysisException as error:
            if not nothing_written(error):
                raise
            return {}
        if any((row.first_day, row.last_day) != self.period for row in records):
            raise ValueError(f"Run {self.run_id!r} is of another period")
        return {
            row.layer: LayerRun(
                row.rows_written,
                row.days,
                None
                if row.delivered is None
                else {"delivered": row.delivered, "outside": row.outside, "unreadable": row.unreadable},
            )
            for row in records
        }

    def add(self, layer: str, run: LayerRun) -> None:
        counts = [(run.period or {}).get(name) for name in ("delivered", "outside", "unreadable")]
        days = None if run.days is None else list(run.days)
        row = (self.run_id, layer, dt.datetime.now(), *self.period, days, run.rows, *counts)
        with self.one_at_a_time:
            Writer.get_writer(self.tables.runs).load(self.spark.createDataFrame([row], RUN_SCHEMA).coalesce(1))


@dataclass(frozen=True)
class FlowRun:
    """What a run did: its layers (those done before, too), and the statistics, computed only if used."""

    layers: Mapping[str, LayerRun]
    statistics: DataFrame
    period_statistics: DataFrame | None


def period_statistics(spark: SparkSession, counts: Mapping[str, int], keep_unparseable: bool = False) -> DataFrame:
    """What a period filter removed, like ``validation_statistics``: steps ``outside_period`` and ``unreadable_time``."""
    rows_in, outside = counts["delivered"], counts["outside"]
    unreadable = 0 if keep_unparseable else counts["unreadable"]
    rows = [
        ("outside_period", rows_in, outside, rows_in - outside),
        ("unreadable_time", rows_in - outside, unreadable, rows_in - outside - unreadable),
    ]
    return spark.createDataFrame(rows, "step string, rows_in long, rows_removed long, rows_out long")


def run_flow(
    spark: SparkSession,
    flow: Flow,
    raw: Spec | DataFrame | None = None,
    date_filter: Spec | None = None,
    run_id: str | None = None,
) -> FlowRun:
    """All layers, each from the written table before it; cleansed and quarantine side by side.

    With a ``run_id`` every finished layer is recorded in the table ``runs``, and a run of that
    id that failed goes on with the layers that are missing: those done before, and made from
    layers done before, are neither read nor written again. (A driver that dies after a layer's write
    and before its record runs that layer again; in tables whose days are replaced that changes nothing.)
    """
    record = RunRecord(spark, flow.tables, run_id, date_filter) if run_id is not None else None
    before = record.done() if record else {}
    runs: dict[str, LayerRun] = {}
    kept: set[str | None] = {None}

    def step(layer: str) -> None:
        days = runs["ingestion"].days if "ingestion" in runs else None
        runs[layer] = run_layer(spark, layer, flow, raw, date_filter, days)
        if record:
            record.add(layer, runs[layer])

    for level in (("ingestion",), ("cleansed", "quarantine"), ("curated",)):
        for layer in level:
            if layer in before and SOURCE[layer] in kept:
                runs[layer] = before[layer]
                kept.add(layer)
        missing = [layer for layer in level if layer not in runs]
        if len(missing) == 1:
            step(missing[0])
        elif missing:
            with ThreadPoolExecutor(max_workers=len(missing)) as side_by_side:
                jobs = [side_by_side.submit(inheritable_thread_target(spark)(step), layer) for layer in missing]
                for job in jobs:
                    job.result()

    ingested = flow.tables.readings(spark, "ingestion", date_filter, runs["ingestion"].days)
    unique = runs["cleansed"].rows
    statistics = cleansing_statistics(
        ingested, dict(flow.schema), flow.dynamic_conditions, flow.rules, flow.dedupe_keys, unique
    )
    counts = runs["ingestion"].period
    keep = bool(date_filter and date_filter.get("keep_unparseable"))
    return FlowRun(
        {layer: runs[layer] for layer in LAYERS},
        statistics,
        period_statistics(spark, counts, keep) if counts is not None else None,
    )


def run_layers(
    spark: SparkSession,
    raw: Spec | DataFrame,
    tables: LayerTables,
    schema: dict[str, str] = READING_SCHEMA,
    date_filter: Spec | None = None,
    dynamic_conditions: Iterable[str] | None = None,
    rules: Iterable[str] = DEFAULT_RULES,
    dedupe_keys: Sequence[str] | None = None,
    audit_time: Column | None = None,
    **more: Any,
) -> DataFrame:
    """Raw readings through ingestion, cleansed and quarantine side by side, and curated.

    ``raw`` is a frame of text columns or a source spec; a CSV spec names a directory. The
    period filter applies to every layer that holds readings. Returns the statistics of the
    cleansed layer, which are computed only if used. ``more`` are further fields of ``Flow``; ``run_flow``
    also gives the counts of the period and goes on with a run that failed.

    The raw text is read and cast once. Each layer reads the written table before it, so a lost
    executor costs a recomputation from columnar files, never from the raw text, and all layers
    see one audit time.
    """
    flow = Flow(
        tables,
        schema,
        rules=tuple(rules),
        dynamic_conditions=tuple(dynamic_conditions or ()),
        dedupe_keys=dedupe_keys,
        audit_time=audit_time,
        **more,
    )
    return run_flow(spark, flow, raw, date_filter).statistics
