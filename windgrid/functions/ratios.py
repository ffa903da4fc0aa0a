"""Rounded ratios and order-independent sums."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent(part: Column, whole: Column, scale_first: bool = False) -> Column:
    """Share in percent as double, two decimals; null for an empty whole.

    ``scale_first`` multiplies by 100 before dividing. The two orders can differ in the last bit.
    """
    part, whole = part.cast("double"), F.nullif(whole.cast("double"), F.lit(0.0))
    return F.round(part * 100 / whole if scale_first else part / whole * 100, 2)


def decimal_sum(value: Column, scale: int | None) -> Column:
    """Sum as double. With a ``scale`` each value is rounded to that many decimals and added exactly.

    The exact sum is the same in any task order and nearly as fast as a sum of doubles: values are added as whole
    numbers in a 38-digit decimal. A value of 28 digits or more, NaN or infinity fails the job, in and out of ANSI mode.
    """
    if scale is None:
        return F.sum(value)
    return F.sum(whole_units(value, scale)).cast("double") / 10**scale


def whole_units(value: Column, scale: int) -> Column:
    """A value as a whole number of 10**-scale, whose sums are exact: what ``decimal_sum`` adds up."""
    units = F.rint(value * 10**scale)
    # The cast to bigint is the fast one; beyond its range it would clamp outside ANSI mode.
    whole = units.cast("bigint").cast("decimal(28,0)")
    refused = F.raise_error(F.concat(F.lit("a sum with a scale cannot hold the value "), value.cast("string"))).cast("decimal(28,0)")
    wide = F.coalesce(units.try_cast("decimal(28,0)"), refused)
    return F.when(value.isNull(), None).when(F.abs(units) < 2.0**62, whole).otherwise(wide)
