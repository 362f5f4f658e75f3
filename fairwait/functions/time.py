"""Wall-clock timestamps, elapsed hours across clock changes, calendar parts.

Timestamps stay zone-less local time. A zone enters only where elapsed time is
measured, so nothing here depends on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fairwait.schemas import TIME_ZONE

# Fixed value: the only accepted shape of a timestamp text.
STAMP = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d{3}$"


def wall_clock(col: Column) -> Column:
    """``yyyy-MM-ddTHH:mm:ss.SSS`` text as zone-less timestamp; any other text is NULL."""
    return F.when(col.rlike(STAMP), col.try_cast("timestamp_ntz"))


def epoch_seconds(ts: Column, zone: str = TIME_ZONE) -> Column:
    """Whole seconds since 1970 of a local wall-clock time, rounded down."""
    return F.unix_timestamp(F.convert_timezone(F.lit(zone), F.lit("UTC"), ts))


def elapsed_seconds(start: Column, end: Column, zone: str = TIME_ZONE) -> Column:
    return epoch_seconds(end, zone) - epoch_seconds(start, zone)


def seconds_to_hours(seconds: Column) -> Column:
    """Hours to two places, half up, for a non-negative number of whole seconds.

    Integer arithmetic gives the same double as rounding ``seconds / 3600`` through
    a decimal, without building a decimal per row.
    """
    hundredths = F.call_function("div", seconds * F.lit(100) + F.lit(1800), F.lit(3600))
    return hundredths / F.lit(100.0)


def weekday(date: Column) -> Column:
    """0 for Sunday to 6 for Saturday."""
    return F.dayofweek(date) - F.lit(1)
