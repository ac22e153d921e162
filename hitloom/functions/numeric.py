"""Lenient parsing and small numeric rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Years that a nanosecond timestamp can hold.
FIRST_YEAR, LAST_YEAR = 1678, 2262


def lenient_double(value: Column) -> Column:
    """Number, or NULL where the value is no number (NaN included)."""
    number = value.try_cast("double")
    return F.when(~F.isnan(number), number)


def lenient_timestamp(value: Column) -> Column:
    return value.try_cast("timestamp")


def or_default(value: Column, default: float) -> Column:
    """``default`` where the value is missing or zero."""
    number = value.cast("double")
    return F.when(F.coalesce(number, F.lit(0.0)) == 0, F.lit(float(default))).otherwise(number)


def unit_clip(value: Column) -> Column:
    """Clip to 0..1; NULL stays NULL."""
    return F.when(value.isNotNull(), F.least(F.greatest(value, F.lit(0.0)), F.lit(1.0)))


def january_first(year: Column) -> Column:
    """1 January of a year, NULL outside the range a timestamp can hold or for fractions."""
    number = lenient_double(year)
    whole = (number == F.floor(number)) & number.between(FIRST_YEAR, LAST_YEAR)
    safe = F.when(whole, number).otherwise(F.lit(2000.0)).cast("int")
    return F.when(whole, F.make_date(safe, F.lit(1), F.lit(1)))


def sigmoid(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def harmonic_f1(precision: Column, recall: Column) -> Column:
    """F1 with a small constant in the denominator, so that 0/0 is 0."""
    return 2 * precision * recall / (precision + recall + F.lit(1e-8))
