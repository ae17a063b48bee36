"""Daily, seasonal, dashboard and model-quality analytics.

Input is an hourly frame ``city, ts, ghi, temp`` (usually T1 hourly means).
Every operator is a single ``groupBy`` on a key that includes the calendar
date (or season/hour), so the shuffle is on a composite key with map-side
partial aggregation: a hot city is split by date/hour across tasks. Lookups
(monthly factors, seasons) are literal maps folded into the projection, so
there is no join for them at all.

Numbers that the reference rounds are aggregated as exact DECIMAL sums and
rounded HALF_UP in DECIMAL, so results do not depend on row order.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import (
    CO2_KG_PER_KWH,
    MONTHLY_PSH_FACTORS,
    SEASON_OF_MONTH,
    SEASON_REPRESENTATIVE_MONTH_DAY,
    SEASONS,
    CoolingConfig,
    DashboardConfig,
)
from ..functions import decisions as D
from ..functions.numeric import EXACT, MOMENT, exact_sum, quantize, quantized_mean, round_exact

KEY = "city"


def _date(ts: str = "ts") -> Column:
    return F.to_date(F.col(ts))


def month_factor(month: Column) -> Column:
    """Monthly PSH factor as DECIMAL(3,2), default 1.00 (literal map, no join)."""
    pairs = []
    for m, f in MONTHLY_PSH_FACTORS.items():
        pairs += [F.lit(m), F.lit(Decimal(str(f))).cast("decimal(3,2)")]
    return F.coalesce(F.element_at(F.create_map(*pairs), month), F.lit(Decimal("1.00")).cast("decimal(3,2)"))


def season_of(month: Column) -> Column:
    pairs = []
    for m, s in SEASON_OF_MONTH.items():
        pairs += [F.lit(m), F.lit(s)]
    return F.element_at(F.create_map(*pairs), month)


def _psh_from_sum(total: Column, digits: int = 4) -> Column:
    """round(total / 1000, digits) done in DECIMAL, returned as DOUBLE."""
    return F.round(total, digits - 3).cast("double") / F.lit(1000.0)


# -- A1 ---------------------------------------------------------------------

def psh_daily(hourly: DataFrame) -> DataFrame:
    """A1: raw and month-adjusted peak sun hours per city-day (4 dp)."""
    day = hourly.groupBy(KEY, _date().alias("date")).agg(
        exact_sum(F.greatest(F.lit(0.0), F.col("ghi"))).alias("_s")
    )
    f = month_factor(F.month("date"))
    return day.select(
        KEY,
        "date",
        F.month("date").cast("bigint").alias("month"),
        _psh_from_sum(F.col("_s")).alias("psh_raw"),
        f.cast("double").alias("monthly_factor"),
        _psh_from_sum(F.col("_s") * f).alias("psh_adjusted"),
    )


# -- A2 / A3 / A4 -----------------------------------------------------------

def daily_decision_summary(hourly: DataFrame, cfg: CoolingConfig = CoolingConfig()) -> DataFrame:
    """A2: hours per decision mode, solar/grid kWh, adjusted PSH per city-day."""
    dec = D.with_decision(hourly, cfg)
    load = round(cfg.electrical_load_kw, 4)
    agg = dec.groupBy(KEY, _date().alias("date")).agg(
        F.count(F.lit(1)).alias("total_hours"),
        F.count_if(F.col("mode") == D.MODE_NO_COOLING).alias("no_cooling_hours"),
        F.count_if(F.col("mode") == D.MODE_SOLAR).alias("solar_hours"),
        F.count_if(F.col("mode") == D.MODE_GRID).alias("grid_hours"),
        exact_sum(F.greatest(F.lit(0.0), F.col("ghi"))).alias("_s"),
    )
    return agg.select(
        KEY,
        "date",
        F.col("total_hours").cast("bigint").alias("total_hours"),
        F.col("no_cooling_hours").cast("bigint").alias("no_cooling_hours"),
        F.col("solar_hours").cast("bigint").alias("solar_hours"),
        F.col("grid_hours").cast("bigint").alias("grid_hours"),
        F.round(F.col("solar_hours") * F.lit(load), 4).alias("solar_energy_kwh"),
        F.round(F.col("grid_hours") * F.lit(load), 4).alias("grid_energy_kwh"),
        _psh_from_sum(F.col("_s") * month_factor(F.month("date"))).alias("psh_adjusted"),
    )


def daily_detail(hourly: DataFrame, as_of, cfg: CoolingConfig = CoolingConfig()) -> DataFrame:
    """A3: A2 plus source mode, the labels of the hours present, and the day's
    24 hour records (T17) as ``profile``: hour, ghi and temp, NULL where the
    hour is missing. Both lists are bounded by the day."""
    summary = daily_decision_summary(hourly, cfg)
    h = F.hour("ts")
    present = F.array_sort(F.collect_list(F.struct(h.alias("hour"), F.col("ghi").alias("ghi"), F.col("temp").alias("temp"))))
    days = hourly.groupBy(KEY, _date().alias("date")).agg(present.alias("_hours"))

    def slot(k: Column) -> Column:
        found = F.get(F.filter("_hours", lambda r: r["hour"] == k), F.lit(0))
        return F.struct(k.alias("hour"), found["ghi"].alias("ghi"), found["temp"].alias("temp"))

    hours = days.select(
        KEY,
        "date",
        F.array_join(F.transform("_hours", lambda r: D.hour_label(r["hour"])), ",").alias("hours"),
        F.transform(F.sequence(F.lit(0), F.lit(23)), slot).alias("profile"),
    )
    return summary.join(hours, [KEY, "date"]).withColumn("source_mode", D.source_mode(F.col("date"), as_of))


def city_operating(hourly: DataFrame, cfg: CoolingConfig = CoolingConfig(), hour_range=(0, 23)) -> DataFrame:
    """A4 + A11: operating %, and peak/avg/PSH over an inclusive hour range.

    Missing hours of the day count as 0 GHI (the dashboard's 24-slot spine).
    """
    lo, hi = hour_range
    n_slots = hi - lo + 1
    s = daily_decision_summary(hourly, cfg)
    in_range = hourly.filter(F.hour("ts").between(lo, hi))
    g = in_range.groupBy(KEY, _date().alias("date")).agg(
        F.max("ghi").alias("_peak"), F.count(F.lit(1)).alias("_n"), exact_sum("ghi").alias("_s")
    )
    peak = F.when(F.col("_n") < n_slots, F.greatest(F.col("_peak"), F.lit(0.0))).otherwise(F.col("_peak"))
    return s.join(g, [KEY, "date"], "left").select(
        KEY,
        "date",
        quantized_mean(
            ((F.col("solar_hours") + F.col("no_cooling_hours")) * 100).cast(EXACT),
            F.greatest(F.col("total_hours"), F.lit(1)),
            1,
        ).alias("operating_pct"),
        F.coalesce(peak, F.lit(0.0)).alias("peak_ghi"),
        (F.coalesce(F.col("_s"), F.lit(0).cast(EXACT)).cast("double") / F.lit(float(n_slots))).alias("avg_ghi"),
        (F.coalesce(F.col("_s"), F.lit(0).cast(EXACT)).cast("double") / F.lit(1000.0)).alias("psh"),
    )


# -- A5 / A6 / A7 -----------------------------------------------------------

def ghi_daily(hourly: DataFrame) -> DataFrame:
    """A5: daily GHI statistics; sunrise/sunset = first/last hour with GHI >= 1."""
    h = F.hour("ts")
    agg = hourly.groupBy(KEY, _date().alias("date")).agg(
        F.max("ghi").alias("_peak"),
        exact_sum("ghi").alias("_s"),
        F.count("ghi").alias("_n"),
        F.count_if(F.col("ghi") < 1.0).alias("zero_hours"),
        F.min(F.when(F.col("ghi") >= 1.0, h)).alias("sunrise_hour"),
        F.max(F.when(F.col("ghi") >= 1.0, h)).alias("sunset_hour"),
    )
    return agg.select(
        KEY,
        "date",
        round_exact("_peak", 2).alias("peak_ghi"),
        quantized_mean(F.col("_s"), F.col("_n"), 2).alias("avg_ghi"),
        F.round("_s", 2).cast("double").alias("total_irradiance_whm2"),
        _psh_from_sum(F.col("_s"), 3).alias("psh"),
        F.col("zero_hours").cast("bigint").alias("zero_hours"),
        F.col("sunrise_hour").cast("bigint").alias("sunrise_hour"),
        F.col("sunset_hour").cast("bigint").alias("sunset_hour"),
    )


def weekly_trend(hourly: DataFrame, days: int = 7) -> DataFrame:
    """A6 for every anchor day: the A5 rows of the ``days`` days ending there.

    Expansion is a fixed fan-out (x days) and an equi-join on (city, date),
    not a pairwise join.
    """
    daily = ghi_daily(hourly)
    anchors = daily.select(
        KEY,
        F.col("date").alias("anchor_date"),
        F.explode(F.sequence(F.lit(0), F.lit(days - 1))).alias("day_offset"),
    ).withColumn("date", F.date_sub(F.col("anchor_date"), F.col("day_offset")))
    return anchors.join(daily, [KEY, "date"]).withColumn("day_offset", F.col("day_offset").cast("bigint"))


def city_profile(hourly: DataFrame) -> DataFrame:
    """Per-city profile for each date: peak, avg over 24 slots, PSH (3 dp)."""
    agg = hourly.groupBy(KEY, _date().alias("date")).agg(F.max("ghi").alias("_peak"), exact_sum("ghi").alias("_s"))
    return agg.select(
        KEY,
        "date",
        round_exact("_peak", 2).alias("peak_ghi"),
        quantized_mean(F.col("_s"), F.lit(24), 2).alias("avg_ghi"),
        _psh_from_sum(F.col("_s"), 3).alias("psh"),
    )


# -- A8 / A9 / A10 ----------------------------------------------------------

def seasonal_curve(hourly: DataFrame, mode: str = "average") -> DataFrame:
    """Season x hour curve (2 dp). ``average`` pools months by season;
    ``representative`` uses each season's representative day of every year."""
    m = F.month("ts")
    src = hourly
    if mode == "representative":
        cond = None
        names = []
        for season, (mm, dd) in SEASON_REPRESENTATIVE_MONTH_DAY.items():
            c = (m == mm) & (F.dayofmonth("ts") == dd)
            cond = c if cond is None else cond | c
            names += [F.lit(mm), F.lit(season)]
        src = hourly.filter(cond)
        season = F.element_at(F.create_map(*names), m)
    elif mode == "average":
        season = season_of(m)
    else:
        raise ValueError(f"unknown seasonal mode {mode!r}")
    agg = src.groupBy(KEY, season.alias("season"), F.hour("ts").cast("bigint").alias("hour")).agg(
        exact_sum("ghi").alias("_sg"), F.count("ghi").alias("_ng"),
        exact_sum("temp").alias("_st"), F.count("temp").alias("_nt"),
    )
    return agg.select(
        KEY,
        "season",
        "hour",
        quantized_mean(F.col("_sg"), F.col("_ng"), 2).alias("avg_ghi_wm2"),
        quantized_mean(F.col("_st"), F.col("_nt"), 2).alias("avg_temp_c"),
    )


def seasonal_summary(curve: DataFrame) -> DataFrame:
    """Per (city, season) summary with both sunrise thresholds (>10, >=1)."""
    g, t, h = F.col("avg_ghi_wm2"), F.col("avg_temp_c"), F.col("hour")
    agg = curve.groupBy(KEY, "season").agg(
        F.max(g).alias("peak_ghi"),
        exact_sum(g).alias("_sg"),
        F.count(g).alias("_n"),
        exact_sum(t).alias("_st"),
        F.count(t).alias("_nt"),
        F.max(t).alias("peak_temp"),
        F.min(F.when(g > 10, h)).alias("sunrise_gt10"),
        F.max(F.when(g > 10, h)).alias("sunset_gt10"),
        F.min(F.when(g >= 1, h)).alias("sunrise_ge1"),
        F.max(F.when(g >= 1, h)).alias("sunset_ge1"),
    )
    return agg.select(
        KEY,
        "season",
        "peak_ghi",
        F.try_divide(F.col("_sg").cast("double"), F.col("_n")).alias("avg_ghi"),
        (F.col("_sg").cast("double") / F.lit(1000.0)).alias("psh"),
        F.try_divide(F.col("_st").cast("double"), F.col("_nt")).alias("avg_temp"),
        "peak_temp",
        *[F.col(c).cast("bigint").alias(c) for c in ("sunrise_gt10", "sunset_gt10", "sunrise_ge1", "sunset_ge1")],
    )


def hour_pivot(curve: DataFrame, dim: str = "season", values=SEASONS, value: str = "avg_ghi_wm2", key: str = KEY) -> DataFrame:
    """A10: hour x dim pivot (season, city or date) for each ``key`` on a
    24-hour spine, missing -> 0."""
    piv = curve.groupBy(key, "hour").pivot(dim, list(values)).agg(F.first(value))
    keys = curve.select(key).distinct()
    spine = keys.select(key, F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(23).cast("bigint"))).alias("hour"))
    out = spine.join(piv, [key, "hour"], "left")
    return out.fillna(0.0, subset=list(values))


# -- B15 series based KPIs (A12-A16, B16) -----------------------------------

def load_series(hourly: DataFrame, cfg: DashboardConfig = DashboardConfig()) -> DataFrame:
    """B13 + B15 on hourly rows; ghi/temp shown at 2 dp as the dashboard does."""
    base = hourly.select(
        KEY,
        "ts",
        _date().alias("date"),
        F.hour("ts").cast("bigint").alias("hour"),
        round_exact("ghi", 2).alias("ghi"),
        round_exact("temp", 2).alias("temp"),
    )
    return D.with_load_series(base, cfg)


def kpi_row(series: DataFrame) -> DataFrame:
    """Self-sufficiency (100 when no cooling hour), peak GHI, PSH, ..."""
    cool = F.col("load_kw") > 0
    agg = series.groupBy(KEY, "date").agg(
        F.count_if(cool).alias("_cool"),
        F.count_if(cool & (F.col("solar_kw") >= F.col("load_kw"))).alias("_cov"),
        F.max("ghi").alias("_peak"),
        exact_sum("ghi").alias("_sg"),
        exact_sum("grid_deficit_kw").alias("_def"),
        exact_sum("solar_kw").alias("_sol"),
        F.count_if(F.col("ghi") < 1).alias("zero_ghi_hours"),
    )
    return agg.select(
        KEY,
        "date",
        F.when(F.col("_cool") > 0, quantized_mean((F.col("_cov") * 100).cast(EXACT), F.col("_cool"), 1))
        .otherwise(F.lit(100.0))
        .alias("self_sufficiency_pct"),
        round_exact("_peak", 0).alias("peak_ghi"),
        _psh_from_sum(F.col("_sg"), 2).alias("psh"),
        F.round("_def", 2).cast("double").alias("total_deficit_kwh"),
        F.round("_sol", 2).cast("double").alias("solar_produced_kwh"),
        F.col("zero_ghi_hours").cast("bigint").alias("zero_ghi_hours"),
    )


def kpi_alt(series: DataFrame) -> DataFrame:
    """Coverage (0 when no active hour), savings, CO2 offset."""
    active = F.col("load_kw") > 0
    agg = series.groupBy(KEY, "date").agg(
        F.count_if(active).alias("_act"),
        F.count_if(active & (F.col("grid_deficit_kw") <= 0)).alias("_sol_h"),
        exact_sum("solar_kw").alias("_sol"),
        exact_sum("grid_deficit_kw").alias("_grid"),
        F.max("ghi").alias("peak_ghi"),
        exact_sum("ghi").alias("_sg"),
    )
    savings = F.col("_sol") - F.col("_grid")
    return agg.select(
        KEY,
        "date",
        F.when(F.col("_act") == 0, F.lit(0.0))
        .otherwise(F.col("_sol_h") / F.col("_act") * F.lit(100.0))
        .alias("solar_coverage_pct"),
        savings.cast("double").alias("savings_kwh"),
        (savings * F.lit(Decimal(str(CO2_KG_PER_KWH)))).cast("double").alias("co2_offset_kg"),
        "peak_ghi",
        (F.col("_sg").cast("double") / F.lit(1000.0)).alias("psh"),
        F.col("_act").cast("bigint").alias("active_hours"),
    )


def cooling_banner(series: DataFrame) -> DataFrame:
    """A14."""
    agg = series.groupBy(KEY, "date").agg(
        F.count_if(F.col("load_kw") > 0).alias("cooling_hours"), F.max("temp").alias("peak_temp")
    )
    return agg.select(
        KEY,
        "date",
        F.col("cooling_hours").cast("bigint").alias("cooling_hours"),
        "peak_temp",
        (F.col("cooling_hours") == 0).alias("all_below"),
    )


def _first_argmax(value: str, digits: int, hour: str = "hour") -> Column:
    """Hour of the maximum, earliest hour on ties, as a hash-aggregatable min.

    ``value`` has at most ``digits`` decimals, so (-value, hour) packs exactly
    into one BIGINT: min(-round(value * 10^d) * 32 + hour) -> pmod(., 32).
    (``min_by`` with a struct ordering would fall back to sort aggregation.)
    """
    key = -F.round(F.col(value) * F.lit(10**digits)).cast("bigint") * 32 + F.col(hour).cast("bigint")
    return F.pmod(F.min(key), F.lit(32))


def thermal_inertia(series: DataFrame) -> DataFrame:
    """Hours from solar peak to load peak, mod 24 (first max wins)."""
    agg = series.groupBy(KEY, "date").agg(
        _first_argmax("load_kw", 3).alias("load_peak_hour"), _first_argmax("solar_kw", 3).alias("solar_peak_hour")
    )
    return agg.select(
        KEY,
        "date",
        F.col("load_peak_hour").cast("bigint").alias("load_peak_hour"),
        F.col("solar_peak_hour").cast("bigint").alias("solar_peak_hour"),
        F.pmod(F.col("load_peak_hour") - F.col("solar_peak_hour") + 24, F.lit(24)).cast("bigint").alias(
            "inertia_hours"
        ),
    )


def peak_hour(hourly: DataFrame) -> DataFrame:
    """Arg-max GHI per city-day, earliest hour on ties."""
    h = hourly.select(KEY, _date().alias("date"), F.hour("ts").alias("hour"), round_exact("ghi", 2).alias("ghi"))
    agg = h.groupBy(KEY, "date").agg(_first_argmax("ghi", 2).alias("peak_hour"), F.max("ghi").alias("peak_ghi"))
    return agg.select(
        KEY, "date", F.col("peak_hour").cast("bigint").alias("peak_hour"), "peak_ghi", D.hour_label("peak_hour").alias(
            "peak_label"
        )
    )


def live_status(series: DataFrame, now_hour: int) -> DataFrame:
    """Status at ``now_hour`` of each city-day, else of its first row.

    The pick order (not-now flag, hour) is packed into one BIGINT so the
    aggregation stays hash-based.
    """
    pick = F.when(F.col("hour") == now_hour, 0).otherwise(1).cast("bigint") * 32 + F.col("hour").cast("bigint")
    src = series.withColumn("_pick", pick)
    agg = src.groupBy(KEY, "date").agg(
        F.min("_pick").alias("_p"), F.min_by("load_kw", "_pick").alias("_load"), F.min_by("solar_kw", "_pick").alias("_solar")
    )
    return agg.select(
        KEY,
        "date",
        F.pmod(F.col("_p"), F.lit(32)).cast("bigint").alias("status_hour"),
        D.live_status(F.col("_load"), F.col("_solar")).alias("status"),
    )


# -- A17 / A18 / A19 --------------------------------------------------------

def daylight_regression(hourly: DataFrame) -> DataFrame:
    """Per city-day least squares temp ~ GHI and Pearson r over GHI > 0.

    Moments are exact DECIMAL sums of the 2-dp display values, so slope and r
    are order-independent. r = 0 on zero variance; n < 2 -> NULL.
    """
    x = round_exact("ghi", 2).cast("decimal(18,2)")
    y = round_exact("temp", 2).cast("decimal(18,2)")
    day = hourly.filter(round_exact("ghi", 2) > 0).select(KEY, _date().alias("date"), x.alias("x"), y.alias("y"))
    agg = day.groupBy(KEY, "date").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("x").alias("sx"),
        F.sum("y").alias("sy"),
        F.sum(F.col("x") * F.col("y")).alias("sxy"),
        F.sum(F.col("x") * F.col("x")).alias("sxx"),
        F.sum(F.col("y") * F.col("y")).alias("syy"),
        F.min("x").alias("min_x"),
        F.max("x").alias("max_x"),
    )
    n = F.col("n")
    sx, sy, sxy, sxx, syy = (F.col(c).cast("double") for c in ("sx", "sy", "sxy", "sxx", "syy"))
    num = n * sxy - sx * sy
    dx = n * sxx - sx * sx
    dy = n * syy - sy * sy
    ok = n >= 2
    slope = F.when(ok & (dx != 0), num / dx)
    intercept = (sy - slope * sx) / n
    r = F.when(ok, F.when((dx > 0) & (dy > 0), num / F.sqrt(dx * dy)).otherwise(F.lit(0.0)))
    return agg.select(
        KEY,
        "date",
        n.cast("bigint").alias("n"),
        slope.alias("slope"),
        F.when(ok, intercept).alias("intercept"),
        r.alias("r"),
        F.when(ok, F.col("min_x").cast("double")).alias("line_start_ghi"),
        F.when(ok, slope * F.col("min_x").cast("double") + intercept).alias("line_start_temp"),
        F.when(ok, F.col("max_x").cast("double")).alias("line_end_ghi"),
        F.when(ok, slope * F.col("max_x").cast("double") + intercept).alias("line_end_temp"),
    )


def ghi_histogram(hourly: DataFrame, width: int = 100) -> DataFrame:
    """Per city-day histogram of the 2-dp GHI, floor bins; hour list <= 24."""
    g = round_exact("ghi", 2)
    h = hourly.select(
        KEY,
        _date().alias("date"),
        (F.floor(g / F.lit(float(width))) * width).cast("bigint").alias("bin_start"),
        D.hour_label(F.hour("ts")).alias("label"),
    )
    agg = h.groupBy(KEY, "date", "bin_start").agg(
        F.count(F.lit(1)).cast("bigint").alias("count"),
        F.array_join(F.array_sort(F.collect_list("label")), ",").alias("hours"),
    )
    return agg.select(
        KEY,
        "date",
        "bin_start",
        (F.col("bin_start") + width).alias("bin_end"),
        F.concat(F.col("bin_start").cast("string"), F.lit("–"), (F.col("bin_start") + width).cast("string")).alias(
            "range"
        ),
        "count",
        "hours",
    )


def corr_matrix(df: DataFrame, cols: list[str], digits: int = 9) -> DataFrame:
    """Pairwise-complete Pearson matrix in long form (NULL on zero variance).

    One global aggregate of (co-)variances over the unordered pairs, of moments
    about the mean, which keep their digits on large means. r lies in [-1, 1]
    and is reported at ``digits`` decimals, so row order cannot change it.
    ANSI-safe: zero variance gives NULL instead of a division error.
    """
    exprs = []
    names = []
    sums = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            if j < i:
                continue  # r is symmetric: aggregate each unordered pair once
            both = F.col(a).isNotNull() & F.col(b).isNotNull()
            p = f"p{i}_{j}"
            sums += [F.covar_pop(a, b).alias(f"{p}_c"), F.var_pop(F.when(both, F.col(a))).alias(f"{p}_a"), F.var_pop(F.when(both, F.col(b))).alias(f"{p}_b")]
            c, va, vb = (F.col(f"{p}_{k}") for k in "cab")
            r = F.when((va > 0) & (vb > 0), c / (F.sqrt(va) * F.sqrt(vb)))
            exprs.append(F.round(F.least(F.greatest(r, F.lit(-1.0)), F.lit(1.0)), digits).alias(p))
            names.append((a, b, p))
    wide = df.agg(*sums).select(*exprs)
    cells = names + [(b, a, p) for a, b, p in names if a != b]
    stack = ", ".join(f"'{a}', '{b}', {p}" for a, b, p in cells)
    return wide.selectExpr(f"stack({len(cells)}, {stack}) AS (col_a, col_b, r)")


# -- forecast quality (A20-A26) ---------------------------------------------

def backtest_pairs(actual: DataFrame, predicted: DataFrame, as_of, days: int = 7) -> DataFrame:
    """Actual vs predicted GHI by (city, date, hour) for the ``days``
    complete days before ``as_of``; both sides are equi-joined on keys."""
    lo = F.date_sub(F.lit(as_of).cast("date"), days)
    hi = F.date_sub(F.lit(as_of).cast("date"), 1)

    def side(df, name):
        return df.select(
            KEY, _date().alias("date"), F.hour("ts").cast("bigint").alias("hour"), round_exact("ghi", 2).alias(name)
        ).filter(F.col("date").between(lo, hi))

    pairs = side(actual, "actual_ghi").join(side(predicted, "predicted_ghi"), [KEY, "date", "hour"])
    return pairs.select(
        "*",
        F.abs(F.col("actual_ghi") - F.col("predicted_ghi")).alias("abs_error"),
        D.day_hour_label("date", "hour").alias("label"),
    )


def backtest_daily(pairs: DataFrame) -> DataFrame:
    """Per-day MAE, RMSE and point count."""
    e = F.col("abs_error").cast("decimal(20,2)")
    agg = pairs.groupBy(KEY, "date").agg(
        F.sum(e).alias("_se"), F.sum(e * e).alias("_se2"), F.count(F.lit(1)).alias("points")
    )
    return agg.select(
        KEY,
        "date",
        (F.col("_se").cast("double") / F.col("points")).alias("mae"),
        F.sqrt(F.col("_se2").cast("double") / F.col("points")).alias("rmse"),
        F.col("points").cast("bigint").alias("points"),
    )


def persistence_predictions(hourly: DataFrame, lags=(1, 24)) -> DataFrame:
    """naive forecasters (value ``lag`` hours earlier, same city) in long
    form ``model_name, target, city, ts, actual, predicted``.

    The shifted copies are one generator plus one equi-join on (city, ts).
    """
    src = hourly.select("city", "ts", "ghi", "temp").withColumn(
        "lag", F.explode(F.array(*[F.lit(int(k)) for k in lags]))
    )
    shifted = src.select(
        "city",
        F.timestamp_add("HOUR", F.col("lag"), F.col("ts")).alias("ts"),
        "lag",
        F.col("ghi").alias("p_ghi"),
        F.col("temp").alias("p_temp"),
    )
    pairs = hourly.select("city", "ts", "ghi", "temp").join(shifted, ["city", "ts"])
    rows = F.explode(
        F.array(
            F.struct(F.lit("GHI").alias("target"), F.col("ghi").alias("actual"), F.col("p_ghi").alias("predicted")),
            F.struct(F.lit("Temp").alias("target"), F.col("temp").alias("actual"), F.col("p_temp").alias("predicted")),
        )
    )
    out = pairs.select("city", "ts", "lag", rows.alias("r"))
    return out.select(
        F.concat(F.lit("persistence_"), F.col("lag").cast("string"), F.lit("h_"), F.col("r.target")).alias("model_name"),
        F.col("r.target").alias("target"),
        "city",
        "ts",
        F.col("r.actual").alias("actual"),
        F.col("r.predicted").alias("predicted"),
    )


def regression_metrics(pred: DataFrame, group: list[str], y: str = "actual", yhat: str = "predicted") -> DataFrame:
    """MAE, RMSE, R^2 = 1 - SSE / SST per group.

    Residuals and actuals are quantized to 1e-6 and summed exactly, so the
    metrics do not depend on row order.
    """
    e = quantize(F.col(yhat) - F.col(y)).cast(MOMENT)
    yq = quantize(F.col(y)).cast(MOMENT)
    agg = pred.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.abs(e)).cast("double").alias("_sae"),
        F.sum(e * e).cast("double").alias("_see"),
        F.sum(yq).cast("double").alias("_sy"),
        F.sum(yq * yq).cast("double").alias("_syy"),
    )
    sst = F.col("_syy") - F.col("_sy") * F.col("_sy") / F.col("n")
    return agg.select(
        *group,
        (F.col("_sae") / F.col("n")).alias("mae"),
        F.sqrt(F.col("_see") / F.col("n")).alias("rmse"),
        F.when(sst > 0, F.lit(1.0) - F.col("_see") / sst).alias("r2"),
        F.col("n").cast("bigint").alias("n"),
    )


KDE_BINS_PER_STEP = 65  # bins between two grid places


def residual_density(resid: DataFrame, group: list[str], value: str = "residual", points: int = 64, per_step: int = KDE_BINS_PER_STEP) -> DataFrame:
    """Gaussian KDE of residuals on a fixed grid per group, linearly binned.

    Bandwidth = sample sigma * n^(-1/5) (exact moments); the grid spans
    [min - 3h, max + 3h]. Every residual is shared by its two nearest bins, of
    which ``per_step`` lie between two grid places, in exact units of 2^-20;
    the density is the sum of bins x kernel. The data are aggregated once to a
    row a bin, whatever the number of places; only that table meets the grid.
    """
    x = quantize(F.col(value)).cast(MOMENT)
    last = (points - 1) * per_step  # bins 0 .. last, grid places every per_step-th
    stats = (
        resid.groupBy(*group)
        .agg(
            F.count(x).alias("_n"),
            F.sum(x).cast("double").alias("_sx"),
            F.sum(x * x).cast("double").alias("_sxx"),
            F.min(value).alias("_lo"),
            F.max(value).alias("_hi"),
        )
        .select(
            *group,
            "_n",
            "_lo",
            "_hi",
            (
                F.sqrt(F.greatest((F.col("_sxx") - F.col("_sx") * F.col("_sx") / F.col("_n")) / (F.col("_n") - 1), F.lit(0.0)))
                * F.pow(F.col("_n").cast("double"), F.lit(-0.2))
            ).alias("_h"),
        )
        .filter((F.col("_n") >= 2) & (F.col("_h") > 0))
        .select(
            *group,
            "_n",
            "_h",
            (F.col("_lo") - F.lit(3.0) * F.col("_h")).alias("_x0"),
            ((F.col("_hi") - F.col("_lo") + F.lit(6.0) * F.col("_h")) / F.lit(float(last))).alias("_w"),
        )
    )
    placed = resid.select(*group, value).where(F.col(value).isNotNull()).join(stats, group).withColumn("_p", (F.col(value) - F.col("_x0")) / F.col("_w"))
    placed = placed.withColumn("_bin", F.least(F.floor("_p"), F.lit(last - 1)))
    share = F.floor((F.col("_p") - F.col("_bin")) * F.lit(float(1 << 20)) + F.lit(0.5)).cast("bigint")
    bins = placed.groupBy(*group, "_n", "_h", "_x0", "_w", "_bin").agg(F.count(F.lit(1)).alias("_c"), F.sum(share).alias("_up"))
    # What a bin has handed up belongs to the next one.
    both = F.explode(F.array(F.struct(F.col("_bin").alias("j"), (F.col("_c") * F.lit(1 << 20) - F.col("_up")).alias("m")), F.struct((F.col("_bin") + 1).alias("j"), F.col("_up").alias("m"))))
    mass = bins.select(*group, "_n", "_h", "_x0", "_w", both.alias("_b")).select(*group, "_n", "_h", "_x0", "_w", "_b.j", "_b.m")
    at = mass.select("*", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("_k"))
    z = (F.col("_k") * F.lit(per_step) - F.col("j")) * F.col("_w") / F.col("_h")
    total = F.sum(F.col("m").cast("double") * F.exp(F.lit(-0.5) * z * z))
    norm = F.col("_n") * F.col("_h") * F.lit((2.0 * 3.141592653589793) ** 0.5) * F.lit(float(1 << 20))
    return at.groupBy(*group, "_n", "_h", "_x0", "_w", "_k").agg(total.alias("_t")).select(
        *group, F.col("_k").cast("bigint").alias("grid_idx"), (F.col("_x0") + F.col("_k") * F.lit(per_step) * F.col("_w")).alias("x"), (F.col("_t") / norm).alias("density")
    )


def model_rank(metrics: DataFrame) -> DataFrame:
    """Rank within target family (name contains GHI / Temp) by MAE."""
    fam = F.when(F.col("model_name").contains("GHI"), F.lit("GHI")).when(
        F.col("model_name").contains("Temp"), F.lit("Temp")
    )
    m = metrics.withColumn("family", fam).filter(F.col("family").isNotNull())
    w = Window.partitionBy("family").orderBy(F.col("mae").asc(), F.col("model_name").asc())
    wf = Window.partitionBy("family")
    return m.select(
        "family",
        "model_name",
        "mae",
        "rmse",
        "r2",
        F.row_number().over(w).cast("bigint").alias("rank"),
        (F.row_number().over(w) == 1).alias("is_champion"),
        F.when(F.max("mae").over(wf) > 0, F.col("mae") / F.max("mae").over(wf) * 100).otherwise(F.lit(0.0)).alias(
            "mae_bar_pct"
        ),
        F.when(F.max("rmse").over(wf) > 0, F.col("rmse") / F.max("rmse").over(wf) * 100).otherwise(F.lit(0.0)).alias(
            "rmse_bar_pct"
        ),
    )


def importance_rank(importance: DataFrame) -> DataFrame:
    """Sort descending, percent to 1 dp, rank 1.."""
    w = Window.orderBy(F.col("importance").desc(), F.col("feature").asc())
    return importance.select(
        "feature",
        "importance",
        F.round(F.col("importance") * 100, 1).alias("importance_pct"),
        F.row_number().over(w).cast("bigint").alias("rank"),
    )


# -- A28 / A29 / B24 --------------------------------------------------------

def profile_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """Total rows, distinct cities, missing cells per column."""
    return df.agg(
        F.count(F.lit(1)).cast("bigint").alias("total_rows"),
        F.count_distinct(KEY).cast("bigint").alias("distinct_cities"),
        *[F.count_if(F.col(c).isNull()).cast("bigint").alias(f"missing_{c}") for c in cols],
    )


def cyclical_integrity(df: DataFrame) -> DataFrame:
    """sin^2 + cos^2 deviation and number of distinct phase points."""
    return df.agg(
        F.max(F.abs(F.col("hour_sin") ** 2 + F.col("hour_cos") ** 2 - 1)).alias("hour_max_dev"),
        F.max(F.abs(F.col("month_sin") ** 2 + F.col("month_cos") ** 2 - 1)).alias("month_max_dev"),
        F.count_distinct(F.round("hour_sin", 9), F.round("hour_cos", 9)).cast("bigint").alias("hour_points"),
        F.count_distinct(F.round("month_sin", 9), F.round("month_cos", 9)).cast("bigint").alias("month_points"),
    )


def last_n_dates(hourly: DataFrame, n: int = 7) -> DataFrame:
    """Rows of each city's last ``n`` distinct dates.

    The ranking runs on distinct (city, date) pairs -- one row per day -- so
    the per-city window is bounded by the number of days, not raw rows.
    """
    days = hourly.select(KEY, _date().alias("date")).distinct()
    w = Window.partitionBy(KEY).orderBy(F.col("date").desc())
    keep = days.select(KEY, "date", F.dense_rank().over(w).alias("date_rank")).filter(F.col("date_rank") <= n)
    return hourly.withColumn("date", _date()).join(keep, [KEY, "date"])
