from gustline.functions.casts import lenient_cast
from gustline.functions.rules import all_not_null, any_null, get_conditions, holds, quoted
from gustline.functions.types import not_null_columns, spark_type, spark_type_name
from gustline.functions.zones import instant, local_day, midnight

__all__ = [
    "all_not_null",
    "any_null",
    "get_conditions",
    "holds",
    "instant",
    "lenient_cast",
    "local_day",
    "midnight",
    "not_null_columns",
    "quoted",
    "spark_type",
    "spark_type_name",
]
