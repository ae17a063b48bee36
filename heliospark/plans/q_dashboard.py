"""Dashboard series, KPI and seasonal plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import ALT_DASHBOARD, SEASONS, DashboardConfig
from ..functions import decisions as D
from ..operators import analytics as A
from . import sqltext as S
from .catalog import query
from .common import dense_hourly, long_hourly

DASH = DashboardConfig()
ALT = ALT_DASHBOARD
NOW_HOUR = 12  # injected "current hour" for the live status pill


# -- SQL: B13 + B15 series over "hourly" --------------------------------------

def _window_sql(cfg: DashboardConfig) -> str:
    s, e = cfg.op_start_hour, cfg.op_end_hour
    if s is None or e is None:
        return "true"
    if s <= e:
        return f"(hour BETWEEN {s} AND {e})"
    return f"(hour >= {s} OR hour <= {e})"


def series_cte(cfg: DashboardConfig, name: str = "ser") -> str:
    return (
        f"{name}0 AS (SELECT city, ts, CAST(ts AS DATE) AS date, CAST(hour(ts) AS BIGINT) AS hour, "
        f"{S.rnd('ghi', 2)} AS ghi, {S.rnd('temp', 2)} AS temp FROM hourly), "
        f"{name}1 AS (SELECT *, round({S.dbl(cfg.dc_kw)} * (ghi / {S.dbl(1000)}) * {S.dbl(cfg.efficiency)}, 3) "
        f"AS solar_kw, CASE WHEN coalesce(temp >= {S.dbl(cfg.cooling_threshold_c)}, false) AND {_window_sql(cfg)} "
        f"THEN {S.dbl(round(cfg.load_kw_base, 3))} ELSE {S.dbl(0)} END AS load_kw FROM {name}0), "
        f"{name} AS (SELECT *, round(greatest({S.dbl(0)}, load_kw - solar_kw), 3) AS grid_deficit_kw FROM {name}1)"
    )


def _series(spark, sf_dir, cfg=DASH):
    return A.load_series(dense_hourly(spark, sf_dir), cfg)


@query(
    "operating_window",
    "B13 B15 B18 B22 B25",
    f"WITH {S.CTE_DENSE_HOURLY}, {series_cte(ALT)} SELECT city, ts, date, hour, "
    f"{S.hour_label('hour')} AS hour_label, ghi, temp, solar_kw, load_kw, grid_deficit_kw, "
    f"{_window_sql(ALT)} AS in_window, CASE WHEN ghi IS NOT NULL THEN least(greatest(ghi, {S.dbl(0)}), {S.dbl(1100)}) END AS ghi_clamped, "
    f"least(ghi / {S.dbl(1000)}, {S.dbl(1)}) AS heat_intensity FROM ser",
)
def operating_window(spark, sf_dir):
    """Load / deficit series with the 08-20 operating window, labels, clamp, heat."""
    ser = _series(spark, sf_dir, ALT)
    return ser.select(
        "city",
        "ts",
        "date",
        "hour",
        D.hour_label("hour").alias("hour_label"),
        "ghi",
        "temp",
        "solar_kw",
        "load_kw",
        "grid_deficit_kw",
        D.in_operating_window("hour", ALT.op_start_hour, ALT.op_end_hour).alias("in_window"),
        D.clamp("ghi", 0.0, 1100.0).alias("ghi_clamped"),
        D.heat_intensity("ghi").alias("heat_intensity"),
    )


@query(
    "kpi_row",
    "A12 B15",
    f"WITH {S.CTE_DENSE_HOURLY}, {series_cte(DASH)}, k AS (SELECT city, date, "
    "count(*) FILTER (WHERE load_kw > 0) AS cool, "
    "count(*) FILTER (WHERE load_kw > 0 AND solar_kw >= load_kw) AS cov, max(ghi) AS peak, "
    f"{S.xsum('ghi')} AS sg, {S.xsum('grid_deficit_kw')} AS sdef, {S.xsum('solar_kw')} AS ssol, "
    "count(*) FILTER (WHERE ghi < 1) AS zero_ghi_hours FROM ser GROUP BY 1, 2) "
    f"SELECT city, date, CASE WHEN cool > 0 THEN {S.qmean(f'CAST(cov * 100 AS {S.DEC})', 'cool', 1)} "
    f"ELSE {S.dbl(100)} END AS self_sufficiency_pct, {S.rnd('peak', 0)} AS peak_ghi, "
    f"{S.psh_from_sum('sg', 2)} AS psh, CAST(round(sdef, 2) AS DOUBLE) AS total_deficit_kwh, "
    "CAST(round(ssol, 2) AS DOUBLE) AS solar_produced_kwh, CAST(zero_ghi_hours AS BIGINT) AS zero_ghi_hours FROM k",
)
def kpi_row(spark, sf_dir):
    return A.kpi_row(_series(spark, sf_dir, DASH))


@query(
    "kpi_alt",
    "A13 B13",
    f"WITH {S.CTE_DENSE_HOURLY}, {series_cte(ALT)}, k AS (SELECT city, date, "
    "count(*) FILTER (WHERE load_kw > 0) AS act, count(*) FILTER (WHERE load_kw > 0 AND grid_deficit_kw <= 0) AS sh, "
    f"{S.xsum('solar_kw')} AS sol, {S.xsum('grid_deficit_kw')} AS grid, max(ghi) AS peak_ghi, {S.xsum('ghi')} AS sg "
    "FROM ser GROUP BY 1, 2) SELECT city, date, "
    f"CASE WHEN act = 0 THEN {S.dbl(0)} ELSE sh / act * {S.dbl(100)} END AS solar_coverage_pct, "
    "CAST(sol - grid AS DOUBLE) AS savings_kwh, CAST((sol - grid) * CAST(0.44 AS DECIMAL(3,2)) AS DOUBLE) "
    f"AS co2_offset_kg, peak_ghi, CAST(sg AS DOUBLE) / {S.dbl(1000)} AS psh, CAST(act AS BIGINT) AS active_hours FROM k",
)
def kpi_alt(spark, sf_dir):
    return A.kpi_alt(_series(spark, sf_dir, ALT))


@query(
    "cooling_banner",
    "A14",
    f"WITH {S.CTE_DENSE_HOURLY}, {series_cte(DASH)} SELECT city, date, "
    "CAST(count(*) FILTER (WHERE load_kw > 0) AS BIGINT) AS cooling_hours, max(temp) AS peak_temp, "
    "count(*) FILTER (WHERE load_kw > 0) = 0 AS all_below FROM ser GROUP BY 1, 2",
)
def cooling_banner(spark, sf_dir):
    return A.cooling_banner(_series(spark, sf_dir, DASH))


@query(
    "thermal_inertia",
    "A15 O3",
    f"WITH {S.CTE_DENSE_HOURLY}, {series_cte(ALT)}, x AS (SELECT *, max(load_kw) OVER (PARTITION BY city, date) AS ml, "
    "max(solar_kw) OVER (PARTITION BY city, date) AS ms FROM ser), p AS (SELECT city, date, "
    "min(hour) FILTER (WHERE load_kw = ml) AS lp, min(hour) FILTER (WHERE solar_kw = ms) AS sp FROM x GROUP BY 1, 2) "
    "SELECT city, date, CAST(lp AS BIGINT) AS load_peak_hour, CAST(sp AS BIGINT) AS solar_peak_hour, "
    "CAST(((lp - sp + 24) % 24 + 24) % 24 AS BIGINT) AS inertia_hours FROM p",
)
def thermal_inertia(spark, sf_dir):
    return A.thermal_inertia(_series(spark, sf_dir, ALT))


@query(
    "peak_hour",
    "A16 O3",
    f"WITH {S.CTE_DENSE_HOURLY}, h AS (SELECT city, CAST(ts AS DATE) AS date, hour(ts) AS hour, "
    f"{S.rnd('ghi', 2)} AS ghi FROM hourly), x AS (SELECT *, max(ghi) OVER (PARTITION BY city, date) AS mg FROM h) "
    "SELECT city, date, CAST(min(hour) FILTER (WHERE ghi = mg) AS BIGINT) AS peak_hour, max(ghi) AS peak_ghi, "
    f"{S.hour_label('min(hour) FILTER (WHERE ghi = mg)')} AS peak_label FROM x GROUP BY 1, 2",
)
def peak_hour(spark, sf_dir):
    return A.peak_hour(dense_hourly(spark, sf_dir))


@query(
    "live_status",
    "B16",
    f"WITH {S.CTE_DENSE_HOURLY}, {series_cte(DASH)}, r AS (SELECT *, row_number() OVER (PARTITION BY city, date "
    f"ORDER BY CASE WHEN hour = {NOW_HOUR} THEN 0 ELSE 1 END, hour) AS rn FROM ser) "
    "SELECT city, date, hour AS status_hour, CASE WHEN load_kw IS NULL OR load_kw <= 0 THEN 'STANDBY' "
    "WHEN solar_kw >= load_kw THEN 'SOLAR PRIORITY' ELSE 'GRID ACTIVE' END AS status FROM r WHERE rn = 1",
)
def live_status(spark, sf_dir):
    return A.live_status(_series(spark, sf_dir, DASH), NOW_HOUR)


# -- seasonal (F3) -------------------------------------------------------------

def _curve_sql(mode: str) -> str:
    if mode == "average":
        season = S.season_of("month(ts)")
        where = ""
    else:
        from ..config import SEASON_REPRESENTATIVE_MONTH_DAY as R

        season = "(CASE month(ts) " + " ".join(f"WHEN {m} THEN '{s}'" for s, (m, _) in R.items()) + " END)"
        where = "WHERE " + " OR ".join(f"(month(ts) = {m} AND day(ts) = {d})" for m, d in R.values())
    return (
        f"SELECT city, {season} AS season, CAST(hour(ts) AS BIGINT) AS hour, "
        f"{S.qmean(S.xsum('ghi'), 'count(ghi)', 2)} AS avg_ghi_wm2, "
        f"{S.qmean(S.xsum('temp'), 'count(temp)', 2)} AS avg_temp_c FROM hourly {where} GROUP BY 1, 2, 3"
    )


@query("seasonal_curve", "A8", f"WITH {S.CTE_LONG_HOURLY} {_curve_sql('average')}", dates=())
def seasonal_curve(spark, sf_dir):
    return A.seasonal_curve(long_hourly(spark, sf_dir), "average")


@query(
    "seasonal_curve_representative", "A8 R10", f"WITH {S.CTE_LONG_HOURLY} {_curve_sql('representative')}", dates=()
)
def seasonal_curve_representative(spark, sf_dir):
    return A.seasonal_curve(long_hourly(spark, sf_dir), "representative")


@query(
    "seasonal_summary",
    "A9 R11",
    f"WITH {S.CTE_LONG_HOURLY}, curve AS ({_curve_sql('average')}) SELECT city, season, max(avg_ghi_wm2) AS peak_ghi, "
    f"CAST({S.xsum('avg_ghi_wm2')} AS DOUBLE) / count(avg_ghi_wm2) AS avg_ghi, "
    f"CAST({S.xsum('avg_ghi_wm2')} AS DOUBLE) / {S.dbl(1000)} AS psh, "
    f"CAST({S.xsum('avg_temp_c')} AS DOUBLE) / count(avg_temp_c) AS avg_temp, max(avg_temp_c) AS peak_temp, "
    "CAST(min(CASE WHEN avg_ghi_wm2 > 10 THEN hour END) AS BIGINT) AS sunrise_gt10, "
    "CAST(max(CASE WHEN avg_ghi_wm2 > 10 THEN hour END) AS BIGINT) AS sunset_gt10, "
    "CAST(min(CASE WHEN avg_ghi_wm2 >= 1 THEN hour END) AS BIGINT) AS sunrise_ge1, "
    "CAST(max(CASE WHEN avg_ghi_wm2 >= 1 THEN hour END) AS BIGINT) AS sunset_ge1 FROM curve GROUP BY 1, 2",
    dates=(),
)
def seasonal_summary(spark, sf_dir):
    return A.seasonal_summary(A.seasonal_curve(long_hourly(spark, sf_dir), "average"))


@query(
    "hour_pivot",
    "A10 J7",
    f"WITH {S.CTE_LONG_HOURLY}, curve AS ({_curve_sql('average')}), "
    "spine AS (SELECT DISTINCT city, CAST(h AS BIGINT) AS hour FROM curve, range(0, 24) r(h)) SELECT s.city, s.hour, "
    + ", ".join(
        f"coalesce(max(CASE WHEN c.season = '{x}' THEN c.avg_ghi_wm2 END), {S.dbl(0)}) AS {x}" for x in SEASONS
    )
    + " FROM spine s LEFT JOIN curve c ON s.city = c.city AND s.hour = c.hour GROUP BY 1, 2",
    dates=(),
)
def hour_pivot(spark, sf_dir):
    return A.hour_pivot(A.seasonal_curve(long_hourly(spark, sf_dir), "average"), "season", SEASONS)


# -- A17 / A18 -----------------------------------------------------------------

@query(
    "daylight_regression",
    "A17",
    f"WITH {S.CTE_DENSE_HOURLY}, d AS (SELECT city, CAST(ts AS DATE) AS date, "
    f"CAST({S.rnd('ghi', 2)} AS DECIMAL(18,2)) AS x, CAST({S.rnd('temp', 2)} AS DECIMAL(18,2)) AS y FROM hourly "
    f"WHERE {S.rnd('ghi', 2)} > 0), a AS (SELECT city, date, count(*) AS n, CAST(sum(x) AS DOUBLE) AS sx, "
    "CAST(sum(y) AS DOUBLE) AS sy, CAST(sum(x * y) AS DOUBLE) AS sxy, CAST(sum(x * x) AS DOUBLE) AS sxx, "
    "CAST(sum(y * y) AS DOUBLE) AS syy, min(x) AS min_x, max(x) AS max_x FROM d GROUP BY 1, 2), "
    "b AS (SELECT *, n * sxy - sx * sy AS num, n * sxx - sx * sx AS dx, n * syy - sy * sy AS dy FROM a), "
    "c AS (SELECT *, CASE WHEN n >= 2 AND dx <> 0 THEN num / dx END AS slope FROM b) "
    "SELECT city, date, CAST(n AS BIGINT) AS n, slope, CASE WHEN n >= 2 THEN (sy - slope * sx) / n END AS intercept, "
    f"CASE WHEN n >= 2 THEN CASE WHEN dx > 0 AND dy > 0 THEN num / sqrt(dx * dy) ELSE {S.dbl(0)} END END AS r, "
    "CASE WHEN n >= 2 THEN CAST(min_x AS DOUBLE) END AS line_start_ghi, "
    "CASE WHEN n >= 2 THEN slope * CAST(min_x AS DOUBLE) + (sy - slope * sx) / n END AS line_start_temp, "
    "CASE WHEN n >= 2 THEN CAST(max_x AS DOUBLE) END AS line_end_ghi, "
    "CASE WHEN n >= 2 THEN slope * CAST(max_x AS DOUBLE) + (sy - slope * sx) / n END AS line_end_temp FROM c",
)
def daylight_regression(spark, sf_dir):
    return A.daylight_regression(dense_hourly(spark, sf_dir))


@query(
    "ghi_histogram",
    "A18",
    f"WITH {S.CTE_DENSE_HOURLY}, h AS (SELECT city, CAST(ts AS DATE) AS date, "
    f"CAST(floor({S.rnd('ghi', 2)} / {S.dbl(100)}) * 100 AS BIGINT) AS bin_start, {S.hour_label('hour(ts)')} AS label "
    "FROM hourly) SELECT city, date, bin_start, bin_start + 100 AS bin_end, "
    "CAST(bin_start AS VARCHAR) || '–' || CAST(bin_start + 100 AS VARCHAR) AS range, CAST(count(*) AS BIGINT) AS count, "
    "string_agg(label, ',' ORDER BY label) AS hours FROM h GROUP BY 1, 2, 3",
)
def ghi_histogram(spark, sf_dir):
    return A.ghi_histogram(dense_hourly(spark, sf_dir), 100)


@query(
    "last_n_dates",
    "B24 U3 O4",
    f"WITH {S.CTE_DENSE_HOURLY}, d AS (SELECT DISTINCT city, CAST(ts AS DATE) AS date FROM hourly), "
    "r AS (SELECT city, date, dense_rank() OVER (PARTITION BY city ORDER BY date DESC) AS date_rank FROM d) "
    "SELECT h.city, h.ts, h.ghi, h.temp, r.date, CAST(r.date_rank AS INTEGER) AS date_rank FROM hourly h "
    "JOIN r ON h.city = r.city AND CAST(h.ts AS DATE) = r.date WHERE r.date_rank <= 7",
)
def last_n_dates(spark, sf_dir):
    return A.last_n_dates(dense_hourly(spark, sf_dir), 7).select(
        "city", "ts", "ghi", "temp", "date", F.col("date_rank").cast("int").alias("date_rank")
    )
