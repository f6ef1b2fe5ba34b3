"""Fixed values of the wind-turbine data model; every operator takes them as defaults."""

ENTITY = "turbine_id"
EVENT_TIME = "timestamp"
MEASURE = "power_output"
AUDIT = "metadata_datetime_created"

# Declared columns of a reading, in PostgreSQL spelling.
READING_SCHEMA = {
    "timestamp": "TIMESTAMP",
    "turbine_id": "INTEGER",
    "wind_speed": "DOUBLE PRECISION",
    "wind_direction": "INTEGER",
    "power_output": "DOUBLE PRECISION",
    "metadata_datetime_created": "TIMESTAMP NOT NULL",
}

# Declared columns of a turbine-day summary.
CURATED_SCHEMA = {
    "turbine_id": "INTEGER",
    "date": "DATE",
    "mean_power_output": "DOUBLE PRECISION",
    "min_power_output": "DOUBLE PRECISION",
    "max_power_output": "DOUBLE PRECISION",
    "anomalous_power_output": "BOOLEAN",
}

# Physical limits of a valid reading (bounds are inclusive).
DEFAULT_RULES = [
    "wind_speed BETWEEN 0 AND 25",
    "wind_direction BETWEEN 0 AND 360",
    "power_output >= 0",
]

# Fixed value: a day is anomalous beyond this many population standard deviations.
ANOMALY_SIGMAS = 2

# The columns a raw CSV delivers, all as text.
RAW_COLUMNS = [name for name in READING_SCHEMA if name != AUDIT]
