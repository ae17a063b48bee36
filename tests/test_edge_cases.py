"""Hand-computed micro tables for edge cases."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from heliospark.config import ALT_DASHBOARD, CoolingConfig, DashboardConfig
from heliospark.functions import decisions as D
from heliospark.operators import analytics as A
from heliospark.operators import timeseries as TS

T0 = dt.datetime(2024, 3, 1)


def _series(spark, values, city="X", col="ghi"):
    rows = [(city, T0 + dt.timedelta(hours=i), v, 20.0) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "city string, ts timestamp, ghi double, temp double")


def _grid(spark, values):
    df = _series(spark, values)
    # nulls inside the series must survive as grid holes: build the grid from
    # the full hour range, then null the values
    return TS.hourly_grid(df)


def test_gap_runs_lengths_and_positions(spark):
    vals = [None, 1.0, None, None, None, 5.0, None, None, None, None, 10.0, None]
    runs = TS.gap_runs(_grid(spark, vals)).orderBy("run_start").collect()
    got = [(r["run_length"], r["is_long"], r["position"]) for r in runs]
    assert got == [(1, False, "leading"), (3, False, "interior"), (4, True, "interior"), (1, False, "trailing")]


def test_short_gap_interpolation_exactly_three_and_not_four(spark):
    vals = [0.0, None, None, None, 4.0, None, None, None, None, 9.0]
    g = TS.hourly_grid(_series(spark, vals))
    n = TS._neighbours(g, "ghi")
    out = n.select("i", TS.short_gap_fill(n, "ghi", "s1", 3)).orderBy("i").collect()
    s1 = [r["s1"] for r in out]
    assert s1[:5] == [0.0, 1.0, 2.0, 3.0, 4.0]
    assert s1[5:9] == [None, None, None, None]


def test_leading_and_trailing_runs_stay_null_after_tier1(spark):
    vals = [None, None, 3.0, 4.0, None]
    g = TS.hourly_grid(_series(spark, vals))
    n = TS._neighbours(g, "ghi")
    s1 = [r["s1"] for r in n.select("i", TS.short_gap_fill(n, "ghi", "s1", 3)).orderBy("i").collect()]
    assert s1 == [None, None, 3.0, 4.0, None]


def test_single_row_city_and_rolling_std_needs_two(spark):
    df = _series(spark, [7.0], city="solo").unionByName(_series(spark, [1.0, 3.0], city="pair"))
    out = {(r["city"], r["ts"]): r for r in TS.with_rolling(TS.hourly_grid(df)).collect()}
    solo = out[("solo", T0)]
    assert solo["ghi_rolling_mean_3h"] is None and solo["ghi_rolling_std_3h"] is None
    second = out[("pair", T0 + dt.timedelta(hours=1))]
    assert second["ghi_rolling_mean_3h"] == 1.0 and second["ghi_rolling_std_3h"] is None


def test_scaler_population_sigma_and_zero_variance(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (None, 5.0)], "temp double, ghi_lag_1 double")
    out = TS.standardise(df, ["temp", "ghi_lag_1"], checkpoint_input=False).collect()
    temps = sorted(r["temp"] for r in out if r["temp"] is not None)
    assert temps == [-1.0, 1.0]  # population sigma of (1, 3) is 1
    assert all(r["ghi_lag_1"] == 0.0 for r in out)  # sigma 0 -> divide by 1


def test_decision_sample_row(spark):
    df = spark.createDataFrame([("Lahore", T0, 780.0, 34.0)], "city string, ts timestamp, ghi double, temp double")
    r = D.with_decision(df, CoolingConfig()).collect()[0]
    assert r["mode"] == "RUN_ON_SOLAR" and r["solar_generation_kw"] == 4.992 and r["electrical_load_kw"] == 2.0
    assert r["no_cooling_needed_banner"] is None


def test_no_cooling_banner_and_grid(spark):
    df = spark.createDataFrame(
        [("a", T0, 100.0, 20.0), ("a", T0, 100.0, 30.0)], "city string, ts timestamp, ghi double, temp double"
    )
    rows = D.with_decision(df, CoolingConfig()).orderBy("temp").collect()
    assert rows[0]["mode"] == "NO_COOLING_NEEDED" and rows[0]["no_cooling_needed_banner"] == "NO COOLING NEEDED"
    assert rows[1]["mode"] == "RUN_ON_GRID"


def test_operating_window_wraps_midnight(spark):
    df = spark.range(24).select(F.col("id").cast("int").alias("hour"))
    got = [r["w"] for r in df.select(D.in_operating_window("hour", 22, 5).alias("w")).orderBy("hour").collect()]
    assert got == [h >= 22 or h <= 5 for h in range(24)]


def test_all_night_day_has_no_sunrise(spark):
    df = _series(spark, [0.0] * 24)
    r = A.ghi_daily(df).collect()[0]
    assert r["sunrise_hour"] is None and r["sunset_hour"] is None and r["zero_hours"] == 24


def test_argmax_ties_take_first_hour(spark):
    vals = [0.0] * 10 + [500.0, 700.0, 700.0, 100.0] + [0.0] * 10
    r = A.peak_hour(_series(spark, vals)).collect()[0]
    assert r["peak_hour"] == 11 and r["peak_label"] == "11:00"


def test_thermal_inertia_mod_24(spark):
    # temperature peak (load) at hour 2, solar peak at hour 12
    rows = []
    for h in range(24):
        ghi = 900.0 if h == 12 else 10.0
        temp = 30.0 if h == 2 else 10.0
        rows.append(("c", T0 + dt.timedelta(hours=h), ghi, temp))
    df = spark.createDataFrame(rows, "city string, ts timestamp, ghi double, temp double")
    cfg = DashboardConfig(op_start_hour=None, op_end_hour=None)
    r = A.thermal_inertia(A.load_series(df, cfg)).collect()[0]
    assert (r["load_peak_hour"], r["solar_peak_hour"], r["inertia_hours"]) == (2, 12, 14)


def test_regression_zero_variance_r_is_zero(spark):
    rows = [("c", T0 + dt.timedelta(hours=h), 100.0 + h, 25.0) for h in range(5)]
    df = spark.createDataFrame(rows, "city string, ts timestamp, ghi double, temp double")
    r = A.daylight_regression(df).collect()[0]
    assert r["r"] == 0.0 and r["slope"] == 0.0 and r["n"] == 5


def test_regression_needs_two_points(spark):
    df = spark.createDataFrame([("c", T0, 100.0, 25.0)], "city string, ts timestamp, ghi double, temp double")
    r = A.daylight_regression(df).collect()[0]
    assert r["slope"] is None and r["r"] is None


def test_psh_month_factor(spark):
    rows = [("c", dt.datetime(2024, 6, 1, h), 500.0, 20.0) for h in range(8, 16)]
    df = spark.createDataFrame(rows, "city string, ts timestamp, ghi double, temp double")
    r = A.psh_daily(df).collect()[0]
    assert r["psh_raw"] == 4.0 and r["monthly_factor"] == 1.12 and r["psh_adjusted"] == 4.48


def test_kpi_self_sufficiency_100_when_no_cooling(spark):
    df = _series(spark, [100.0] * 24)  # temp 20 < 22
    r = A.kpi_row(A.load_series(df, DashboardConfig())).collect()[0]
    assert r["self_sufficiency_pct"] == 100.0
    alt = A.kpi_alt(A.load_series(df, ALT_DASHBOARD)).collect()[0]
    assert alt["solar_coverage_pct"] == 0.0


def test_histogram_bins(spark):
    r = A.ghi_histogram(_series(spark, [0.0, 99.99, 100.0, 250.0])).orderBy("bin_start").collect()
    assert [(x["bin_start"], x["count"]) for x in r] == [(0, 2), (100, 1), (200, 1)]
    assert r[0]["hours"] == "00:00,01:00"
