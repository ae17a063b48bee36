"""Calendar / cyclical column builders."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import LOCAL_TZ

TWO_PI = 2.0 * math.pi


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def local_ts(ts: str | Column, tz: str = LOCAL_TZ) -> Column:
    """UTC instant -> local wall clock (the stored ``ts`` stays UTC)."""
    return F.from_utc_timestamp(_c(ts), tz)


def cyclical_columns(ts: str | Column, tz: str | None = LOCAL_TZ) -> list[Column]:
    """day_of_year + sin/cos of hour/24 and month/12 on local time."""
    t = local_ts(ts, tz) if tz else _c(ts)
    hour = F.hour(t)
    month = F.month(t)
    return [
        F.dayofyear(t).cast("bigint").alias("day_of_year"),
        F.sin(F.lit(TWO_PI) * hour / F.lit(24.0)).alias("hour_sin"),
        F.cos(F.lit(TWO_PI) * hour / F.lit(24.0)).alias("hour_cos"),
        F.sin(F.lit(TWO_PI) * month / F.lit(12.0)).alias("month_sin"),
        F.cos(F.lit(TWO_PI) * month / F.lit(12.0)).alias("month_cos"),
    ]


def station_calendar_columns(ts: str | Column) -> list[Column]:
    """Station variant on UTC time; keeps hour/doy/month, doy/365.25."""
    t = _c(ts)
    doy = F.dayofyear(t)
    hour = F.hour(t)
    return [
        hour.cast("bigint").alias("hour"),
        doy.cast("bigint").alias("day_of_year"),
        F.month(t).cast("bigint").alias("month"),
        F.sin(F.lit(TWO_PI) * hour / F.lit(24.0)).alias("hour_sin"),
        F.cos(F.lit(TWO_PI) * hour / F.lit(24.0)).alias("hour_cos"),
        F.sin(F.lit(TWO_PI) * doy / F.lit(365.25)).alias("doy_sin"),
        F.cos(F.lit(TWO_PI) * doy / F.lit(365.25)).alias("doy_cos"),
    ]


def is_night(ts: str | Column, start: int = 20, end: int = 5, tz: str = LOCAL_TZ) -> Column:
    """B10 predicate: local hour >= start or <= end."""
    h = F.hour(local_ts(ts, tz))
    return (h >= start) | (h <= end)
