from gustline.operators.periods import (
    day_of,
    filter_ingestion_period,
    period_days,
    period_metrics,
    today_in,
    with_date,
)
from gustline.operators.quality import (
    audit_null_rows,
    constraint_violations,
    declared_constraints,
    declared_violations,
    drop_duplicate_rows,
    keep_invalid,
    keep_valid,
    validation_statistics,
)
from gustline.operators.schema import (
    add_audit_column,
    cast_cleansed_schema,
    cast_columns,
    cast_curated_schema,
    cast_ingestion_schema,
    require_columns,
    schema_drift_report,
    table_column_metadata,
)
from gustline.operators.stats import anomalous_days, daily_statistics, flag_anomalies, min_max, preview

__all__ = [
    "add_audit_column",
    "anomalous_days",
    "audit_null_rows",
    "cast_cleansed_schema",
    "cast_columns",
    "cast_curated_schema",
    "cast_ingestion_schema",
    "constraint_violations",
    "daily_statistics",
    "day_of",
    "declared_constraints",
    "declared_violations",
    "drop_duplicate_rows",
    "filter_ingestion_period",
    "flag_anomalies",
    "keep_invalid",
    "keep_valid",
    "min_max",
    "period_days",
    "period_metrics",
    "preview",
    "require_columns",
    "schema_drift_report",
    "table_column_metadata",
    "today_in",
    "validation_statistics",
    "with_date",
]
