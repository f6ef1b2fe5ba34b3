from gustline.plans.flow import etl
from gustline.plans.layers import (
    cleansed_layer_transform,
    cleansing_statistics,
    curated_layer_transform,
    ingestion_layer_transform,
    quarantine_layer_transform,
)
from gustline.plans.merge import latest_versions, merge_deliveries
from gustline.plans.reports import REPORTS, Report, register_report, run_report
from gustline.plans.runs import Flow, FlowRun, LayerRun, period_statistics, run_flow, run_layer, run_layers
from gustline.plans.tables import LayerTables, daily_parquet_tables, parquet_tables, remove_partitions
from gustline.sources import shared_folder

__all__ = [
    "Flow",
    "FlowRun",
    "LayerRun",
    "LayerTables",
    "REPORTS",
    "Report",
    "cleansed_layer_transform",
    "cleansing_statistics",
    "curated_layer_transform",
    "daily_parquet_tables",
    "etl",
    "ingestion_layer_transform",
    "latest_versions",
    "merge_deliveries",
    "parquet_tables",
    "period_statistics",
    "quarantine_layer_transform",
    "register_report",
    "remove_partitions",
    "run_flow",
    "run_layer",
    "run_layers",
    "run_report",
    "shared_folder",
]
