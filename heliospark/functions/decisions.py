"""Cooling-control column expressions.

Pure column builders: no data movement, everything fuses into the caller's
whole-stage-codegen span. Constants are folded on the driver from frozen
config objects so Catalyst sees literals.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import CoolingConfig, DashboardConfig

MODE_NO_COOLING = "NO_COOLING_NEEDED"
MODE_SOLAR = "RUN_ON_SOLAR"
MODE_GRID = "RUN_ON_GRID"
BANNER_NO_COOLING = "NO COOLING NEEDED"

STATUS_STANDBY = "STANDBY"
STATUS_SOLAR = "SOLAR PRIORITY"
STATUS_GRID = "GRID ACTIVE"


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# -- server-side decision (B11, B12, B14) ----------------------------------

def solar_kw(ghi: str | Column, cfg: CoolingConfig) -> Column:
    """DC kW x max(0, GHI)/1000 (x efficiency when it is not 1)."""
    irr = F.greatest(F.lit(0.0), _c(ghi)) / F.lit(1000.0)
    out = F.lit(cfg.dc_kw) * irr
    if cfg.efficiency != 1.0:
        out = out * F.lit(cfg.efficiency)
    return out


def cooling_needed(temp: str | Column, cfg: CoolingConfig) -> Column:
    """Schedule gate AND temperature at or above the threshold."""
    if not cfg.operating_hours_enabled:
        return F.lit(False)
    return F.coalesce(_c(temp) >= F.lit(cfg.cooling_temp_threshold_c), F.lit(False))


def decision_mode(solar: Column, cooling: Column, cfg: CoolingConfig) -> Column:
    """Compare on the unrounded solar value."""
    return (
        F.when(~cooling, F.lit(MODE_NO_COOLING))
        .when(solar >= F.lit(cfg.electrical_load_kw), F.lit(MODE_SOLAR))
        .otherwise(F.lit(MODE_GRID))
    )


def with_decision(df, cfg: CoolingConfig = CoolingConfig(), ghi="ghi", temp="temp"):
    """Append the decision row fields (B11-B14) to an hourly frame."""
    solar = solar_kw(ghi, cfg)
    cool = cooling_needed(temp, cfg)
    mode = decision_mode(solar, cool, cfg)
    return df.select(
        "*",
        mode.alias("mode"),
        cool.alias("cooling_needed"),
        F.when(mode == MODE_NO_COOLING, F.lit(BANNER_NO_COOLING)).alias("no_cooling_needed_banner"),
        F.round(solar, 4).alias("solar_generation_kw"),
        F.lit(round(cfg.electrical_load_kw, 4)).alias("electrical_load_kw"),
        F.lit(cfg.cooling_capacity_kw_thermal).alias("cooling_capacity_kw_thermal"),
        F.lit(cfg.cop_ideal).alias("cop_ideal"),
    )


# -- dashboard series (B13, B15, B16) ---------------------------------------

def in_operating_window(hour: str | Column, start: int | None, end: int | None) -> Column:
    """Inclusive hour window that wraps midnight when start > end."""
    h = _c(hour)
    if start is None or end is None:
        return F.lit(True)
    if start <= end:
        return h.between(start, end)
    return (h >= start) | (h <= end)


def with_load_series(df, cfg: DashboardConfig = DashboardConfig(), ghi="ghi", temp="temp", hour="hour"):
    """Solar / load / deficit with 3-dp rounding before the compare."""
    solar = F.round(F.lit(cfg.dc_kw) * (_c(ghi) / F.lit(1000.0)) * F.lit(cfg.efficiency), 3)
    cool = F.coalesce(_c(temp) >= F.lit(cfg.cooling_threshold_c), F.lit(False)) & in_operating_window(
        hour, cfg.op_start_hour, cfg.op_end_hour
    )
    load = F.when(cool, F.lit(round(cfg.load_kw_base, 3))).otherwise(F.lit(0.0))
    return (
        df.withColumn("solar_kw", solar)
        .withColumn("load_kw", load)
        .withColumn("grid_deficit_kw", F.round(F.greatest(F.lit(0.0), F.col("load_kw") - F.col("solar_kw")), 3))
    )


def live_status(load: str | Column, solar: str | Column) -> Column:
    """Heartbeat status of one series row."""
    ld, sl = _c(load), _c(solar)
    return (
        F.when(ld.isNull() | (ld <= 0), F.lit(STATUS_STANDBY))
        .when(sl >= ld, F.lit(STATUS_SOLAR))
        .otherwise(F.lit(STATUS_GRID))
    )


# -- misc (B17, B18, B22, B25) ----------------------------------------------

def source_mode(day: str | Column, as_of) -> Column:
    """HISTORICAL up to and including ``as_of``, PREDICTION after."""
    return F.when(_c(day) <= F.lit(as_of), F.lit("HISTORICAL")).otherwise(F.lit("PREDICTION"))


def hour_label(hour: str | Column) -> Column:
    """``HH:00``."""
    return F.concat(F.lpad(_c(hour).cast("string"), 2, "0"), F.lit(":00"))


def day_hour_label(day: str | Column, hour: str | Column) -> Column:
    """``MM-DD HHh``."""
    return F.concat(
        F.date_format(_c(day), "MM-dd"), F.lit(" "), F.lpad(_c(hour).cast("string"), 2, "0"), F.lit("h")
    )


def daylight_range(sunrise: str | Column, sunset: str | Column) -> Column:
    """``HH:00 – HH:00``, or a dash for a day without sun."""
    return F.coalesce(F.concat(hour_label(sunrise), F.lit(" – "), hour_label(sunset)), F.lit("—"))


def clamp(x: str | Column, lo: float, hi: float) -> Column:
    """B22 (NULL stays NULL: ``greatest``/``least`` alone would skip it)."""
    v = _c(x)
    return F.when(v.isNotNull(), F.least(F.greatest(v, F.lit(lo)), F.lit(hi)))


def heat_intensity(ghi: str | Column) -> Column:
    """min(GHI / 1000, 1)."""
    return F.least(_c(ghi) / F.lit(1000.0), F.lit(1.0))
