"""Validation rules as one boolean column."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> Column:
    """The column of exactly this name, dots and blanks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def all_not_null(columns: Iterable[str]) -> Column:
    """TRUE where every named column has a value (NaN is a value)."""
    return reduce(and_, (quoted(name).isNotNull() for name in columns), F.lit(True))


def any_null(columns: Iterable[str]) -> Column:
    """TRUE where at least one named column has no value."""
    return ~all_not_null(columns)


def get_conditions(
    conditions: Iterable[str],
    df: DataFrame | None = None,
    no_nulls: bool = True,
    dynamic_conditions: Iterable[str] | None = None,
) -> Column:
    """AND of SQL rules, each parsed on its own, so a rule's OR stays inside that rule.

    With ``df`` and ``no_nulls`` every column of that frame must also have a value.
    No rule at all is TRUE.
    """
    rules = [*conditions, *(dynamic_conditions or ())]
    combined = reduce(and_, map(F.expr, rules)) if rules else F.lit(True)
    if df is not None and no_nulls:
        combined = combined & all_not_null(df.columns)
    return combined


def holds(condition: Column) -> Column:
    """The condition as plain TRUE or FALSE; unknown counts as FALSE."""
    return F.coalesce(condition, F.lit(False))
