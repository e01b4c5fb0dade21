"""Hour arithmetic and calendar columns on zone-less timestamps."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

NTZ = "timestamp_ntz"
STORM_STAMP = "d-MMM-yy H:mm:ss"


def floor_hour(ts: Column) -> Column:
    return F.date_trunc("hour", ts).cast(NTZ)


def ceil_hour(ts: Column) -> Column:
    """The next full hour; a timestamp already on the hour stays."""
    return F.date_trunc("hour", ts + F.expr("INTERVAL '59:59.999999' MINUTE TO SECOND")).cast(NTZ)


def parse_storm_ts(text: Column) -> Column:
    """``28-APR-15 13:05:00``; anything unreadable becomes NULL."""
    return F.try_to_timestamp(text, F.lit(STORM_STAMP)).cast(NTZ)


def parse_iso_ts(text: Column) -> Column:
    """ISO text; unreadable input raises under ANSI mode, as a bad observation clock must not pass silently."""
    return text.cast(NTZ)


def calendar(hour: Column) -> dict[str, Column]:
    month = F.month(hour)
    of_day = F.hour(hour)
    weekday = F.weekday(hour)
    return {
        "hour_of_day": of_day,
        "month": month,
        "dayofweek": weekday,
        "is_weekend": (weekday >= 5).cast("int"),
        "quarter": F.quarter(hour),
        "day_of_year": F.dayofyear(hour),
        "hour_sin": F.sin(of_day * F.lit(2 * math.pi) / 24),
        "hour_cos": F.cos(of_day * F.lit(2 * math.pi) / 24),
        "month_sin": F.sin(month * F.lit(2 * math.pi) / 12),
        "month_cos": F.cos(month * F.lit(2 * math.pi) / 12),
    }
