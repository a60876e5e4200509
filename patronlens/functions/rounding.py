"""Rounding and safe arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_even(value: Column, digits: int) -> Column:
    """Round a double half-to-even on its scaled binary value (0.125 -> 0.12)."""
    scale = F.lit(float(10**digits))
    return F.rint(value.cast("double") * scale) / scale


def at_least(value: Column, floor: float) -> Column:
    """Lower bound that keeps nulls null."""
    return F.when(value.isNotNull(), F.greatest(value, F.lit(floor)))


def zero_if_missing(value: Column) -> Column:
    """Null and NaN become zero."""
    return F.coalesce(F.nanvl(value.cast("double"), F.lit(0.0)), F.lit(0.0))


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as a double, 0 when ``whole`` is 0."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))
