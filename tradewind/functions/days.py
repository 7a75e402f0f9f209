"""Day arithmetic and calendar labels on zone-less timestamps.

Two day counts exist on purpose: SQL reports cut a duration towards zero while the
feature builders round it down, and the two differ for every early delivery.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def trunc_days(later: Column, earlier: Column) -> Column:
    """Whole days between two timestamps, cut towards zero (-1.5 days -> -1)."""
    return F.extract(F.lit("DAY"), later - earlier).cast("bigint")


def floor_days(later: Column, earlier: Column) -> Column:
    """Whole days between two timestamps, rounded down (-1.5 days -> -2)."""
    whole = trunc_days(later, earlier)
    return whole - (later - earlier < F.make_dt_interval(whole.cast("int"))).cast("bigint")


def epoch_seconds(ts: Column) -> Column:
    """Seconds since 1970 as a double (the session runs in UTC)."""
    return F.unix_micros(ts.cast("timestamp")) / F.lit(1e6)


def month_label(ts: Column) -> Column:
    """Calendar month as 'yyyy-MM' text, which sorts by time."""
    return F.date_format(ts, "yyyy-MM")


def week_start(ts: Column) -> Column:
    """Monday of the Monday-to-Sunday week."""
    return F.date_trunc("week", ts).cast("date")
