"""Epoch / date / ISO expressions (F5-F7), independent of the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MS_PER_DAY = 86_400_000
US_PER_DAY = 86_400_000_000


def event_time_from_ms(ms: Column) -> Column:
    """epoch milliseconds -> TIMESTAMP (an instant, shown in UTC)."""
    return F.timestamp_millis(ms)


def utc_date(ts: Column) -> Column:
    """the UTC calendar date of a TIMESTAMP, whatever the session zone."""
    return F.date_from_unix_date(F.floor(F.unix_micros(ts) / F.lit(US_PER_DAY)).cast("int"))


def _two(x: Column) -> Column:
    return F.lpad(x.cast("string"), 2, "0")


def iso_utc_from_ms(ms: Column) -> Column:
    """ISO-8601 text with ``+00:00``; microseconds only when non-zero.

    Built from integer arithmetic so the session time zone cannot leak in.
    """
    day = F.floor(ms / F.lit(MS_PER_DAY))
    ms_of_day = ms - day * F.lit(MS_PER_DAY)
    secs = F.floor(ms_of_day / 1000)
    frac = ms_of_day - secs * 1000
    clock = F.concat_ws(":", _two(F.floor(secs / 3600)), _two(F.floor(secs / 60) % 60), _two(secs % 60))
    micro = F.when(frac != 0, F.concat(F.lit("."), F.lpad((frac * 1000).cast("string"), 6, "0"))).otherwise(F.lit(""))
    date = F.date_from_unix_date(day.cast("int")).cast("string")
    return F.when(ms.isNotNull(), F.concat(date, F.lit("T"), clock, micro, F.lit("+00:00")))
