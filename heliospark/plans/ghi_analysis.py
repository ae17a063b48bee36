"""Composite GHI analysis for one city and date.

Four parts (daily statistics, seven-day trend, per-city profile on the date,
seasonal curve), each an ordinary DataFrame over the hourly table that reads
only what it needs: the filters on city and date reach the scan below the
hourly means. Nothing is cached or collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import analytics as A
from ..functions.decisions import source_mode


def ghi_analysis(hourly: DataFrame, city: str, date, as_of, seasonal: DataFrame | None = None) -> dict[str, DataFrame]:
    d = F.lit(date).cast("date")
    day = F.to_date("ts")
    own = hourly.filter(F.col("city") == city)
    daily = A.ghi_daily(own.filter(day.between(F.date_sub(d, 6), d)))
    stats = daily.filter(F.col("date") == d).withColumn("source_mode", source_mode(F.col("date"), as_of))
    cities = A.city_profile(hourly.filter(day == d))
    curves = A.seasonal_curve((seasonal if seasonal is not None else hourly).filter(F.col("city") == city), "representative")
    return {"statistics": stats, "weekly_trend": daily, "city_comparison": cities, "seasonal": curves}
