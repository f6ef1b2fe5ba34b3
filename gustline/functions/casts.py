"""Casts that turn bad values into NULL whatever the session's ANSI setting is."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gustline.functions.zones import instant

_BLANK = r"[\x00-\x20\x7F]*"
_WITH_DIGITS = rf"^{_BLANK}[+-]?[0-9]+(\.[0-9]*)?{_BLANK}$"
_FRACTION_ONLY = rf"^{_BLANK}[+-]?\.[0-9]*{_BLANK}$"
_WORDS = "(?i)^(nan|inf)"
_INTEGER_BITS = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}


def lenient_cast(column: Column, source: T.DataType, target: T.DataType, zone: str | None = None) -> Column:
    """``column`` as ``target``; NULL where the value has no such reading.

    Text becomes an integer by dropping its fraction (``'45.7'`` is 45, ``'1e2'`` is NULL).
    A number outside the target's range, or NaN as an integer, is NULL. Times without a zone are read in
    ``zone`` if one is given, else in the session's.
    """
    if source == target:
        return column
    if zone and isinstance(target, T.TimestampType):
        return instant(column, source, zone)
    if isinstance(source, T.StringType) and isinstance(target, T.IntegralType):
        return _text_to_integer(column, target)
    if isinstance(source, T.StringType) and isinstance(target, (T.DoubleType, T.FloatType)):
        return _text_to_float(column, target)
    if isinstance(source, (T.DoubleType, T.FloatType)):
        return _float_to_exact(column, target)
    return column.try_cast(target)


# A try_cast that fails raises and swallows an exception for that row, which made a column with
# 30 % junk ten times slower. So the value is looked at first.


def _text_to_integer(column: Column, target: T.DataType) -> Column:
    # Bare digits, the usual case, are told without a pattern.
    digits_only = (F.ltrim(column, F.lit("0123456789")) == "") & (column != "")
    whole_part = F.substring_index(column, ".", 1).try_cast(target)
    return (
        F.when(digits_only, column.try_cast(target))
        .when(column.rlike(_WITH_DIGITS), whole_part)
        .when(column.rlike(_FRACTION_ONLY), F.lit(0).cast(target))
    )


def _text_to_float(column: Column, target: T.DataType) -> Column:
    # Every number starts with a blank, a sign, a point or a digit, all of which sort before ":".
    return F.when((column < ":") | column.rlike(_WORDS), column.try_cast(target))


def _float_to_exact(column: Column, target: T.DataType) -> Column:
    if isinstance(target, T.DecimalType):
        limit = 10.0 ** (target.precision - target.scale)
    elif type(target) in _INTEGER_BITS:
        limit = 2.0 ** (_INTEGER_BITS[type(target)] - 1)
    else:
        return column.try_cast(target)
    # The limit itself, and fractions just beyond it, are for the cast to judge.
    return F.when(column.between(-limit - 1, limit), column.try_cast(target))
