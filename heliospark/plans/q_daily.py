"""Daily decision and GHI analytics plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import ALT_DASHBOARD, SEASONS, CoolingConfig, DashboardConfig
from ..functions import decisions as D
from ..operators import analytics as A
from ..operators import timeseries as TS
from ..sources import fixtures as FX
from . import sqltext as S
from .catalog import query
from .common import AS_OF, dense_hourly, long_hourly

CFG = CoolingConfig()
DASH = DashboardConfig()
LOAD = round(CFG.electrical_load_kw, 4)

# -- decision modes as SQL over "hourly" ------------------------------------
_SQL_MODE = (
    f"CASE WHEN NOT coalesce(temp >= {S.dbl(CFG.cooling_temp_threshold_c)}, false) THEN 'NO_COOLING_NEEDED' "
    f"WHEN {S.dbl(CFG.dc_kw)} * (greatest({S.dbl(0)}, ghi) / {S.dbl(1000)}) >= {S.dbl(CFG.electrical_load_kw)} "
    "THEN 'RUN_ON_SOLAR' ELSE 'RUN_ON_GRID' END"
)

_SQL_SUMMARY_CTE = (
    "dec AS (SELECT city, CAST(ts AS DATE) AS date, ghi, temp, ts, "
    f"{_SQL_MODE} AS mode FROM hourly), "
    "summ AS (SELECT city, date, CAST(count(*) AS BIGINT) AS total_hours, "
    "CAST(count(*) FILTER (WHERE mode = 'NO_COOLING_NEEDED') AS BIGINT) AS no_cooling_hours, "
    "CAST(count(*) FILTER (WHERE mode = 'RUN_ON_SOLAR') AS BIGINT) AS solar_hours, "
    "CAST(count(*) FILTER (WHERE mode = 'RUN_ON_GRID') AS BIGINT) AS grid_hours, "
    f"{S.xsum(f'greatest({S.dbl(0)}, ghi)')} AS s FROM dec GROUP BY city, date)"
)
_SQL_SUMMARY_COLS = (
    "city, date, total_hours, no_cooling_hours, solar_hours, grid_hours, "
    f"round(CAST(solar_hours AS DOUBLE) * {S.dbl(LOAD)}, 4) AS solar_energy_kwh, "
    f"round(CAST(grid_hours AS DOUBLE) * {S.dbl(LOAD)}, 4) AS grid_energy_kwh, "
    f"{S.psh_from_sum('s * ' + S.month_factor('month(date)'))} AS psh_adjusted"
)

SQL_DAILY_DECISION = f"WITH {S.CTE_DENSE_HOURLY}, {_SQL_SUMMARY_CTE} SELECT {_SQL_SUMMARY_COLS} FROM summ"


@query("daily_decision_summary", "B11 B12 B14 A2 T1", SQL_DAILY_DECISION)
def daily_decision_summary(spark, sf_dir):
    """Flagship: per city-day hours by cooling mode, energy and adjusted PSH."""
    return A.daily_decision_summary(dense_hourly(spark, sf_dir), CFG)


@query(
    "daily_detail",
    "A3 B17 B18",
    f"WITH {S.CTE_DENSE_HOURLY}, {_SQL_SUMMARY_CTE}, "
    f"hl AS (SELECT city, CAST(ts AS DATE) AS date, string_agg({S.hour_label('hour(ts)')}, ',' "
    f"ORDER BY {S.hour_label('hour(ts)')}) AS hours FROM hourly GROUP BY 1, 2) "
    f"SELECT {_SQL_SUMMARY_COLS}, hl.hours, "
    f"CASE WHEN summ.date <= DATE '{AS_OF}' THEN 'HISTORICAL' ELSE 'PREDICTION' END AS source_mode "
    "FROM summ JOIN hl USING (city, date)",
)
def daily_detail(spark, sf_dir):
    return A.daily_detail(dense_hourly(spark, sf_dir), AS_OF, CFG).drop("profile")


@query(
    "daily_detail_hours",
    "A3 T17",
    f"WITH {S.CTE_DENSE_HOURLY}, d AS (SELECT DISTINCT city, CAST(ts AS DATE) AS date FROM hourly), "
    "spine AS (SELECT city, date, CAST(h AS INTEGER) AS hour FROM d, range(0, 24) r(h)) "
    f"SELECT s.city, s.date, CASE WHEN s.date <= DATE '{AS_OF}' THEN 'HISTORICAL' ELSE 'PREDICTION' END AS source_mode, s.hour, h.ghi, h.temp "
    "FROM spine s LEFT JOIN hourly h ON s.city = h.city AND s.date = CAST(h.ts AS DATE) AND s.hour = hour(h.ts)",
)
def daily_detail_hours(spark, sf_dir):
    """The 24 hour records of each city-day's detail."""
    detail = A.daily_detail(dense_hourly(spark, sf_dir), AS_OF, CFG)
    return detail.select("city", "date", "source_mode", F.explode("profile").alias("h")).select("city", "date", "source_mode", "h.*")


@query(
    "hourly_grid",
    "T1 J8",
    f"WITH {S.CTE_DENSE}, {S.hourly_cte('dense', 'sh')}, "
    "bounds AS (SELECT city, min(ts) AS t0, max(ts) AS t1 FROM sh GROUP BY city), "
    "spine AS (SELECT b.city, g.ts, CAST((epoch(g.ts) - epoch(b.t0)) / 3600 AS BIGINT) AS i "
    "FROM bounds b, LATERAL (SELECT unnest(generate_series(b.t0, b.t1, INTERVAL 1 HOUR)) AS ts) g) "
    "SELECT s.city, s.ts, s.i, h.ghi, h.temp FROM spine s LEFT JOIN sh h ON s.city = h.city AND s.ts = h.ts",
    dates=(),
)
def hourly_grid(spark, sf_dir):
    return TS.hourly_grid(FX.dense(spark, sf_dir))


@query(
    "psh_daily",
    "A1 J5",
    f"WITH {S.CTE_LONG_HOURLY}, d AS (SELECT city, CAST(ts AS DATE) AS date, "
    f"{S.xsum(f'greatest({S.dbl(0)}, ghi)')} AS s FROM hourly GROUP BY 1, 2) "
    "SELECT city, date, CAST(month(date) AS BIGINT) AS month, "
    f"{S.psh_from_sum('s')} AS psh_raw, CAST({S.month_factor('month(date)')} AS DOUBLE) AS monthly_factor, "
    f"{S.psh_from_sum('s * ' + S.month_factor('month(date)'))} AS psh_adjusted FROM d",
)
def psh_daily(spark, sf_dir):
    return A.psh_daily(long_hourly(spark, sf_dir))


_SQL_GHI_DAILY = (
    f"SELECT city, CAST(ts AS DATE) AS date, {S.rnd('max(ghi)', 2)} AS peak_ghi, "
    f"{S.qmean(S.xsum('ghi'), 'count(ghi)', 2)} AS avg_ghi, "
    f"CAST(round({S.xsum('ghi')}, 2) AS DOUBLE) AS total_irradiance_whm2, "
    f"{S.psh_from_sum(S.xsum('ghi'), 3)} AS psh, "
    "CAST(count(*) FILTER (WHERE ghi < 1.0) AS BIGINT) AS zero_hours, "
    "CAST(min(CASE WHEN ghi >= 1.0 THEN hour(ts) END) AS BIGINT) AS sunrise_hour, "
    "CAST(max(CASE WHEN ghi >= 1.0 THEN hour(ts) END) AS BIGINT) AS sunset_hour "
    "FROM hourly GROUP BY 1, 2"
)


@query("ghi_daily", "A5", f"WITH {S.CTE_DENSE_HOURLY} {_SQL_GHI_DAILY}")
def ghi_daily(spark, sf_dir):
    return A.ghi_daily(dense_hourly(spark, sf_dir))


@query(
    "weekly_trend",
    "A6",
    f"WITH {S.CTE_DENSE_HOURLY}, daily AS ({_SQL_GHI_DAILY}), "
    "anch AS (SELECT city, date AS anchor_date, CAST(o AS BIGINT) AS day_offset, "
    "CAST(date - CAST(o AS INTEGER) AS DATE) AS date FROM daily, range(0, 7) r(o)) "
    "SELECT a.city, a.date, a.anchor_date, a.day_offset, d.peak_ghi, d.avg_ghi, d.total_irradiance_whm2, "
    "d.psh, d.zero_hours, d.sunrise_hour, d.sunset_hour FROM anch a JOIN daily d USING (city, date)",
    dates=("date", "anchor_date"),
)
def weekly_trend(spark, sf_dir):
    return A.weekly_trend(dense_hourly(spark, sf_dir))


@query(
    "city_profile",
    "A7",
    f"WITH {S.CTE_DENSE_HOURLY} SELECT city, CAST(ts AS DATE) AS date, {S.rnd('max(ghi)', 2)} AS peak_ghi, "
    f"{S.qmean(S.xsum('ghi'), '24', 2)} AS avg_ghi, {S.psh_from_sum(S.xsum('ghi'), 3)} AS psh "
    "FROM hourly GROUP BY 1, 2",
)
def city_profile(spark, sf_dir):
    return A.city_profile(dense_hourly(spark, sf_dir))


@query(
    "city_operating",
    "A4 A11 B23",
    f"WITH {S.CTE_DENSE_HOURLY}, {_SQL_SUMMARY_CTE}, "
    f"g AS (SELECT city, CAST(ts AS DATE) AS date, max(ghi) AS peak, {S.xsum('ghi')} AS sg FROM hourly "
    "WHERE hour(ts) BETWEEN 0 AND 23 GROUP BY 1, 2) "
    "SELECT summ.city, summ.date, "
    f"{S.qmean(f'CAST((solar_hours + no_cooling_hours) * 100 AS {S.DEC})', 'greatest(total_hours, 1)', 1)} "
    "AS operating_pct, "
    "coalesce(peak, 0.0) AS peak_ghi, CAST(coalesce(sg, 0) AS DOUBLE) / 24.0 AS avg_ghi, "
    "CAST(coalesce(sg, 0) AS DOUBLE) / 1000.0 AS psh FROM summ LEFT JOIN g USING (city, date)",
)
def city_operating(spark, sf_dir):
    return A.city_operating(dense_hourly(spark, sf_dir), CFG, (0, 23))


@query(
    "daily_profile",
    "T17 J7",
    f"WITH {S.CTE_DENSE_HOURLY}, d AS (SELECT DISTINCT city, CAST(ts AS DATE) AS date FROM hourly), "
    "spine AS (SELECT city, date, CAST(h AS INTEGER) AS hour FROM d, range(0, 24) r(h)) "
    "SELECT s.city, s.date, s.hour, h.ghi, h.temp FROM spine s LEFT JOIN hourly h "
    "ON s.city = h.city AND s.date = CAST(h.ts AS DATE) AND s.hour = hour(h.ts)",
)
def daily_profile(spark, sf_dir):
    """24 UTC slots per city-day from the hourly table; missing -> NULL."""
    return TS.daily_profile(dense_hourly(spark, sf_dir))
