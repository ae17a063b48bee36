"""Small helpers that render the same expressions as DuckDB SQL text.

The oracle SQL is generated from the same frozen constants as the Spark
plans, so a parameter change moves both sides together.
"""

from __future__ import annotations

from ..config import MONTHLY_PSH_FACTORS, SEASON_OF_MONTH
from ..sources.fixtures import SQL_DENSE, SQL_LONG, SQL_SITES

DEC = "DECIMAL(24,6)"


def dbl(x: float) -> str:
    return f"CAST({float(x)!r} AS DOUBLE)"


def xsum(e: str) -> str:
    return f"sum(CAST({e} AS {DEC}))"


def xavg(e: str) -> str:
    return f"CASE WHEN count({e}) > 0 THEN CAST({xsum(e)} AS DOUBLE) / count({e}) END"


def qmean(total: str, n: str, digits: int = 6, total_scale: int = 6) -> str:
    """Integer HALF_UP of total / n at ``digits`` decimals (see quantized_mean)."""
    unit = 10 ** (total_scale - digits)
    si = f"CAST(({total}) * {10**total_scale} AS BIGINT)"
    return (
        f"CASE WHEN ({n}) > 0 THEN sign({si}) * ((2 * abs({si}) + ({n}) * {unit}) // (2 * {unit} * ({n}))) / "
        f"CAST({10**digits} AS DOUBLE) END"
    )


def rnd(x: str, digits: int) -> str:
    """Display rounding of a derived double (see round_exact)."""
    return f"CAST(round(CAST({x} AS {DEC}), {digits}) AS DOUBLE)"


def psh_from_sum(s: str, digits: int = 4) -> str:
    return f"CAST(round({s}, {digits - 3}) AS DOUBLE) / 1000"


def month_factor(month: str) -> str:
    whens = " ".join(f"WHEN {m} THEN CAST({f} AS DECIMAL(3,2))" for m, f in MONTHLY_PSH_FACTORS.items())
    return f"(CASE {month} {whens} ELSE CAST(1.00 AS DECIMAL(3,2)) END)"


def season_of(month: str) -> str:
    whens = " ".join(f"WHEN {m} THEN '{s}'" for m, s in SEASON_OF_MONTH.items())
    return f"(CASE {month} {whens} END)"


def hour_label(h: str) -> str:
    return f"(lpad(CAST({h} AS VARCHAR), 2, '0') || ':00')"


def hourly_cte(source: str, name: str = "hourly") -> str:
    return (
        f"{name} AS (SELECT city, date_trunc('hour', ts) AS ts, {xavg('ghi')} AS ghi, {xavg('temp')} AS temp "
        f"FROM {source} GROUP BY 1, 2)"
    )


CTE_DENSE = f"dense AS ({SQL_DENSE})"
SQL_DENSE_WRAPPED = f"SELECT * FROM ({SQL_DENSE}) q"
CTE_SITES = f"sites AS ({SQL_SITES})"
CTE_LONG = f"long AS ({SQL_LONG})"
CTE_DENSE_HOURLY = CTE_DENSE + ", " + hourly_cte("dense")
CTE_LONG_HOURLY = CTE_LONG + ", " + hourly_cte("long")

# Per-site hourly grid (T1) with grid index i.
CTE_SITES_GRID = (
    CTE_SITES
    + ", "
    + hourly_cte("sites", "sh")
    + ", bounds AS (SELECT city, min(ts) AS t0, max(ts) AS t1 FROM sh GROUP BY city)"
    + ", spine AS (SELECT b.city, g.ts, CAST((epoch(g.ts) - epoch(b.t0)) / 3600 AS BIGINT) AS i "
    + "FROM bounds b, LATERAL (SELECT unnest(generate_series(b.t0, b.t1, INTERVAL 1 HOUR)) AS ts) g)"
    + ", grid AS (SELECT s.city, s.ts, s.i, h.ghi, h.temp FROM spine s LEFT JOIN sh h ON s.city = h.city AND s.ts = h.ts)"
)
