"""Frozen configuration objects and fixed lookup values.

All business constants are parameters; the defaults are the values the
reference's server, dashboard and training scripts use.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference for identical results.
# ---------------------------------------------------------------------------

# Monthly peak-sun-hour adjustment factors, month 1..12 (default 1.0 otherwise).
MONTHLY_PSH_FACTORS: dict[int, float] = {
    1: 0.78,
    2: 0.82,
    3: 0.90,
    4: 1.00,
    5: 1.08,
    6: 1.12,
    7: 1.10,
    8: 1.04,
    9: 0.96,
    10: 0.88,
    11: 0.82,
    12: 0.76,
}

# Hourly payload variables, in payload order.
HOURLY_VARIABLES: tuple[str, ...] = (
    "temperature_2m",
    "relative_humidity_2m",
    "wind_speed_10m",
    "cloud_cover",
    "shortwave_radiation",
    "direct_radiation",
    "direct_normal_irradiance",
    "diffuse_radiation",
)

# Station header aliases applied after name normalisation.
STATION_ALIASES: dict[str, str] = {
    "temp": "temperature",
    "winddirection": "wind_direction",
    "windspeed": "wind_speed",
    "windgust": "wind_gust",
    "tair_avg": "temperature",
    "tamb": "temperature",
    "rh_avg": "humidity",
    "rh": "humidity",
    "bp_cs100_avg": "pressure",
    "bp": "pressure",
    "ghi_corr_avg": "ghi",
    "dni_corr_avg": "dni",
    "dhi_corr_avg": "dhi",
    "ws": "wind_speed",
    "wsgust": "wind_gust",
    "wd": "wind_direction",
    "timestamp": "timestamp",
    "ts": "timestamp",
    "ws_wvc_1": "wind_speed",
}

# Canonical station numeric columns, in order.
STATION_NUMERIC: tuple[str, ...] = (
    "temperature",
    "humidity",
    "wind_direction",
    "wind_speed",
    "wind_gust",
    "pressure",
    "ghi",
    "dni",
    "dhi",
)

# Representative dates used by the seasonal curve ("representative" mode).
SEASON_REPRESENTATIVE_MONTH_DAY: dict[str, tuple[int, int]] = {
    "Summer": (7, 15),
    "Autumn": (10, 15),
    "Winter": (1, 15),
    "Spring": (4, 15),
}

# Lags (rows) used by the hourly feature matrix.
LAG_HOURS: tuple[int, ...] = (1, 2, 3, 24, 48)
# Lags used by the station feature frame.
STATION_GHI_LAGS: tuple[int, ...] = (1, 2, 3, 24)

LOCAL_TZ = "Asia/Karachi"  # UTC+05:00, no daylight saving
LOCAL_OFFSET_HOURS = 5
CO2_KG_PER_KWH = 0.44

# Meteorological seasons used by the "average" seasonal mode.
SEASON_OF_MONTH: dict[int, str] = {
    12: "Winter", 1: "Winter", 2: "Winter",
    3: "Spring", 4: "Spring", 5: "Spring",
    6: "Summer", 7: "Summer", 8: "Summer",
    9: "Autumn", 10: "Autumn", 11: "Autumn",
}
SEASONS: tuple[str, ...] = ("Winter", "Spring", "Summer", "Autumn")


# The defaults of the classes below, cooling, dashboard and tree constants, are
# fixed values as well.


@dataclass(frozen=True)
class CoolingConfig:
    """Server-side decision constants."""

    cooling_capacity_kw_thermal: float = 20.0
    cop_ideal: float = 10.0
    panel_count: int = 10
    panel_watt_rating: float = 640.0
    cooling_temp_threshold_c: float = 24.0
    efficiency: float = 1.0
    operating_hours_enabled: bool = True

    @property
    def electrical_load_kw(self) -> float:
        return self.cooling_capacity_kw_thermal / self.cop_ideal

    @property
    def dc_kw(self) -> float:
        return self.panel_count * self.panel_watt_rating / 1000.0


@dataclass(frozen=True)
class DashboardConfig:
    """Client-side series constants."""

    cooling_capacity_kw_thermal: float = 20.0
    target_cop: float = 10.0
    panel_count: int = 10
    panel_watt_rating: float = 640.0
    cooling_threshold_c: float = 22.0
    efficiency: float = 0.85
    op_start_hour: int | None = None  # None = no operating window
    op_end_hour: int | None = None

    @property
    def load_kw_base(self) -> float:
        return self.cooling_capacity_kw_thermal / self.target_cop

    @property
    def dc_kw(self) -> float:
        return self.panel_count * self.panel_watt_rating / 1000.0


# The alternative dashboard: 8..20 operating window (wrap-around allowed).
ALT_DASHBOARD = DashboardConfig(op_start_hour=8, op_end_hour=20)


@dataclass(frozen=True)
class BoostedTreeParams:
    """Boosted-tree hyper-parameters (M2)."""

    step_size: float = 0.05
    max_depth: int = 5
    max_iter: int = 200
    subsampling_rate: float = 1.0
    feature_subset_strategy: str = "all"
    seed: int = 42


HOURLY_TREE_PARAMS = BoostedTreeParams()
STATION_TREE_PARAMS = BoostedTreeParams(
    max_depth=6, max_iter=500, subsampling_rate=0.9, feature_subset_strategy="0.9"
)


@dataclass(frozen=True)
class ImputeConfig:
    short_gap_max: int = 3
    history_days: int = 7
    night_start_hour: int = 20  # local hour >= this is night
    night_end_hour: int = 5  # local hour <= this is night
    local_offset_hours: int = LOCAL_OFFSET_HOURS
    features: tuple[str, ...] = field(default=("ghi", "temp"))
