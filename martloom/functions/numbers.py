"""Numeric coercion and masking."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A plain decimal number of any length. Spark alone would also take '1d' or 'inf'.
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_DIGITS = r"^\s*[+-]?\d+\s*$"
# Digits and a fraction of zeros, and a plain number too short to overflow: the usual cases, settled by one test.
_WHOLE = r"^\s*[+-]?\d+\.0*\s*$"
_SHORT = r"^\s*[+-]?(\d{1,300}(\.\d*)?|\.\d+)\s*$"
_LARGEST = 1.7976931348623157e308
_LONGS = 2.0**63

# Fixed value: a duration this long or longer stands for "not measured".
SECONDS_LIMIT = 999


def to_double(col: Column) -> Column:
    """Number text to DOUBLE; bad text, overflow, inf and nan become NULL."""
    text = col.cast("string")
    number = text.try_cast("double")
    return F.when(text.rlike(_SHORT), number).when(text.rlike(_NUMBER) & (F.abs(number) <= _LARGEST), number)


def to_long(col: Column) -> Column:
    """Whole number text to BIGINT, also when written '10001.0', '1e4' or '1500e-1'; a fraction becomes NULL.

    Most texts take one test and one cast; the double is only looked at for numbers written otherwise.
    """
    text = col.cast("string")
    number = text.try_cast("double")
    whole = (number == F.floor(number)) & (number >= -_LONGS) & (number < _LONGS)
    return (
        F.when(text.rlike(_DIGITS), text.try_cast("bigint"))
        .when(text.rlike(_WHOLE), F.substring_index(text, ".", 1).try_cast("bigint"))
        .when(text.rlike(_NUMBER) & whole, number.try_cast("bigint"))
    )


def mask_seconds(value: Column, limit: float = SECONDS_LIMIT) -> Column:
    """Durations outside [0, limit) become NULL."""
    return F.when((value >= 0) & (value < limit), value)


def clean_seconds(col: Column, limit: float = SECONDS_LIMIT) -> Column:
    """Duration text to DOUBLE, masked."""
    return mask_seconds(to_double(col), limit)


def zero_if_null(col: Column) -> Column:
    return F.coalesce(col, F.lit(0))


def flag(condition: Column) -> Column:
    """Condition to 0/1; an unknown condition is 0."""
    return F.coalesce(condition.cast("int"), F.lit(0))
