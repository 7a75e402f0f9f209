"""Rounded ratios of counts, computed on integers so that ties never wobble."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column, digits: int = 2) -> Column:
    """numerator / denominator, rounded half away from zero; NULL for a zero denominator.

    Both sides are whole numbers and the denominator is not negative.
    """
    num, den = numerator.cast("bigint"), F.nullif(denominator.cast("bigint"), F.lit(0))
    halves = F.call_function("div", F.abs(num) * (2 * 10**digits) + den, den * 2)
    return F.signum(num) * halves / F.lit(float(10**digits))


def percent(part: Column, total: Column, digits: int = 2) -> Column:
    """part as a percentage of total."""
    return ratio(part.cast("bigint") * 100, total, digits)
