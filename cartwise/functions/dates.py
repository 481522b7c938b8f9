"""Day arithmetic and month truncation on timestamps without a zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_timestamp(value: str | Column) -> Column:
    """A zone-free timestamp from an ISO text or a column."""
    return (F.lit(value) if isinstance(value, str) else value).cast("timestamp_ntz")


def whole_days_between(ts: Column, as_of: str | Column) -> Column:
    """Day part of ``as_of - ts`` as double, truncated toward zero (the SQL form)."""
    return F.extract(F.lit("DAY"), as_timestamp(as_of) - as_timestamp(ts)).cast("double")


def floor_days_between(ts: Column, as_of: str | Column) -> Column:
    """Whole days from ``ts`` to ``as_of``, rounded down (the notebook form).

    Counts midnights and takes one back when the time of day has not been
    reached yet, so no time zone is involved.
    """
    start, end = as_timestamp(ts), as_timestamp(as_of)
    midnights = F.datediff(end, start)
    return (midnights - F.when(start + F.make_dt_interval(midnights) > end, 1).otherwise(0)).cast("long")


def month_start(ts: Column) -> Column:
    """First instant of the month."""
    return F.trunc(ts, "month").cast("timestamp_ntz")
