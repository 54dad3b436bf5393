"""Casting and range expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def lenient_cast(value: Column, source: T.DataType, target: T.DataType) -> Column:
    """Cast `value`, giving NULL where it has no counterpart in `target`.

    Fractions are cut off, in numeric strings too (`'1.7'` -> 1); a number
    outside the target's range gives NULL rather than wrapping round.
    """
    if isinstance(source, T.StringType) and isinstance(target, T.IntegralType):
        value = F.regexp_replace(value, r"^\s*([+-]?)(\d*)\.\d*\s*$", "$10$2")
    return value.try_cast(target)


def out_of_range(value: Column, low: float, high: float) -> Column:
    """True outside [low, high]. NaN counts as above `high`; NULL gives NULL."""
    return (value < low) | (value > high)


def is_missing(value: Column, source: T.DataType) -> Column:
    """NULL, or NaN in a floating-point column — what `dropna` drops."""
    if isinstance(source, (T.DoubleType, T.FloatType)):
        return value.isNull() | F.isnan(value)
    return value.isNull()
