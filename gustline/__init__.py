"""Sensor-reading analytics as plain PySpark DataFrame operators."""

from gustline.functions import get_conditions, lenient_cast
from gustline.operators import *  # noqa: F403
from gustline.plans import *  # noqa: F403
from gustline.sinks import Writer
from gustline.sources import (
    Reader,
    day_predicates,
    get_all_csv_files,
    get_postgresql_options,
    header_catalogue,
    partitioned_read,
    read_csv_directory,
)
