"""Feature-matrix plans.

Input is the sparse per-site view (F2) on its hourly grid: every tier of the
imputation is exercised there (short gaps, same-hour history, climatology).
"""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..config import LAG_HOURS, ImputeConfig
from ..operators import analytics as A
from ..operators import timeseries as TS
from ..sources import fixtures as FX
from . import sqltext as S
from .catalog import query
from .common import AS_OF_TS, sites_grid, stored_grid

IMP = ImputeConfig()
TWO_PI = 2.0 * math.pi
MOMENT = "DECIMAL(16,6)"
# DuckDB multiplies two DECIMAL(<=18) in 64 bits and overflows; widening one
# factor keeps the same exact product as Spark's decimal(33,12).
WIDE = "DECIMAL(19,6)"
CYC = ("hour_sin", "hour_cos", "month_sin", "month_cos")
CORR_COLS = ["target_ghi_next_1h", "temp", "ghi_lag_1", "ghi_lag_24", "ghi_rolling_mean_3h"]


# -- Spark plans ------------------------------------------------------------

def imputed_sites(spark, sf_dir):
    return TS.impute(sites_grid(spark, sf_dir), IMP)


def features_unscaled(spark, sf_dir):
    """B8, T7, T8, T9 over the stored grid: one scan in (city, ts) order."""
    return TS.with_features(stored_grid(spark, sf_dir).select("city", "ts", "ghi", "temp"))


def feature_matrix(spark, sf_dir):
    """T1 -> T6 (the stored grid) -> B8 -> T7 -> T8 -> T9 -> T10. The fit
    and its use each pass over the stored grid; no feature is stored for it."""
    features = features_unscaled(spark, sf_dir)
    return TS.apply_scaler(features, TS.scaler_params(features, SCALED))


def _round_cyc(df, digits=9):
    return df.select(*[F.round(c, digits).alias(c) if c in CYC else F.col(c) for c in df.columns])


# -- SQL text ---------------------------------------------------------------

_W = "PARTITION BY city ORDER BY ts"


def _nb(f: str) -> str:
    back = f"OVER ({_W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    fwd = f"OVER ({_W} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    return (
        f"max(CASE WHEN {f} IS NOT NULL THEN i END) {back} AS {f}_pi, "
        f"last_value({f} IGNORE NULLS) {back} AS {f}_pv, "
        f"min(CASE WHEN {f} IS NOT NULL THEN i END) {fwd} AS {f}_ni, "
        f"first_value({f} IGNORE NULLS) {fwd} AS {f}_nv"
    )


def _s1(f: str) -> str:
    return (
        f"coalesce({f}, CASE WHEN {f}_ni - {f}_pi - 1 <= {IMP.short_gap_max} THEN "
        f"({f}_nv - {f}_pv) / ({f}_ni - {f}_pi) * (i - {f}_pi) + {f}_pv END) AS {f}_s1"
    )


def _s2(f: str) -> str:
    lags = [f"lag({f}_s1, {24 * k}) OVER ({_W})" for k in range(1, IMP.history_days + 1)]
    total = " + ".join(f"coalesce({x}, {S.dbl(0)})" for x in lags)
    count = " + ".join(f"(CASE WHEN {x} IS NOT NULL THEN 1 ELSE 0 END)" for x in lags)
    return f"coalesce({f}_s1, CASE WHEN ({count}) > 0 THEN ({total}) / ({count}) END) AS {f}_s2"


def _s3(f: str) -> str:
    w = "OVER (PARTITION BY city, lmonth, lhour)"
    return f"coalesce({f}_s2, {S.qmean(f'sum(CAST({f}_s2 AS {S.DEC})) {w}', f'count({f}_s2) {w}')}) AS {f}_s3"


def _source(f: str) -> str:
    return (
        f"CASE WHEN {f} IS NOT NULL THEN 'observed' WHEN {f}_s1 IS NOT NULL THEN 'interpolated' "
        f"WHEN {f}_s2 IS NOT NULL THEN 'history' WHEN {f}_s3 IS NOT NULL THEN 'climatology' ELSE 'missing' END"
    )


_NIGHT = f"(lhour >= {IMP.night_start_hour} OR lhour <= {IMP.night_end_hour})"

CTE_IMPUTED = (
    S.CTE_SITES_GRID
    + f", nb AS (SELECT *, {_nb('ghi')}, {_nb('temp')} FROM grid)"
    + f", t1 AS (SELECT *, {_s1('ghi')}, {_s1('temp')}, "
    + f"month(ts + INTERVAL {IMP.local_offset_hours} HOUR) AS lmonth, "
    + f"hour(ts + INTERVAL {IMP.local_offset_hours} HOUR) AS lhour FROM nb)"
    + f", t2 AS (SELECT *, {_s2('ghi')}, {_s2('temp')} FROM t1)"
    + f", t3 AS (SELECT *, {_s3('ghi')}, {_s3('temp')} FROM t2)"
    + f", imp AS (SELECT city, ts, i, CASE WHEN {_NIGHT} THEN {S.dbl(0)} ELSE ghi_s3 END AS ghi, "
    + f"CASE WHEN {_NIGHT} THEN 'night' ELSE {_source('ghi')} END AS ghi_source, "
    + f"temp_s3 AS temp, {_source('temp')} AS temp_source FROM t3)"
)

_LT = f"(ts + INTERVAL {IMP.local_offset_hours} HOUR)"


def _cyc_cols(digits: int | None = None) -> str:
    def r(e):
        return f"round({e}, {digits})" if digits is not None else e

    return (
        f"CAST(dayofyear({_LT}) AS BIGINT) AS day_of_year, "
        f"{r(f'sin({S.dbl(TWO_PI)} * hour({_LT}) / {S.dbl(24)})')} AS hour_sin, "
        f"{r(f'cos({S.dbl(TWO_PI)} * hour({_LT}) / {S.dbl(24)})')} AS hour_cos, "
        f"{r(f'sin({S.dbl(TWO_PI)} * month({_LT}) / {S.dbl(12)})')} AS month_sin, "
        f"{r(f'cos({S.dbl(TWO_PI)} * month({_LT}) / {S.dbl(12)})')} AS month_cos"
    )


def _lag_cols() -> str:
    return ", ".join(f"lag({f}, {k}) OVER ({_W}) AS {f}_lag_{k}" for f in ("ghi", "temp") for k in LAG_HOURS)


def _wmean(f: str, n: int) -> str:
    w = f"OVER ({_W} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
    return S.qmean(f"sum(CAST({f} AS {S.DEC})) {w}", f"count({f}) {w}")


def _wstd(f: str, n: int) -> str:
    w = f"OVER ({_W} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
    x = f"CAST({f} AS {MOMENT})"
    cnt = f"count({f}) {w}"
    sx = f"CAST(sum({x}) {w} AS DOUBLE)"
    sxx = f"CAST(sum(CAST({f} AS {WIDE}) * {x}) {w} AS DOUBLE)"
    sd = f"sqrt(greatest(({sxx} - {sx} * {sx} / {cnt}) / ({cnt} - 1), {S.dbl(0)}))"
    return f"CASE WHEN {cnt} >= 2 THEN floor({sd} * {S.dbl(1e6)} + {S.dbl(0.5)}) / {S.dbl(1e6)} END"


FEATURE_COLS_BASE = ["city", "ts", "ghi", "temp", "day_of_year", *CYC]
LAG_NAMES = [f"{f}_lag_{k}" for f in ("ghi", "temp") for k in LAG_HOURS]
ROLL_NAMES = ["ghi_rolling_mean_3h", "ghi_rolling_std_3h", "temp_rolling_mean_6h"]
TARGETS = ["target_ghi_next_1h", "target_temp_next_1h"]
SCALED = TS.scaled_columns(["temp", *LAG_NAMES, *ROLL_NAMES])

CTE_FEATURES = (
    CTE_IMPUTED
    + f", cyc AS (SELECT city, ts, ghi, temp, {_cyc_cols()} FROM imp)"
    + f", lg AS (SELECT *, {_lag_cols()} FROM cyc)"
    + f", rl AS (SELECT *, {_wmean('ghi', 3)} AS ghi_rolling_mean_3h, {_wstd('ghi', 3)} AS ghi_rolling_std_3h, "
    + f"{_wmean('temp', 6)} AS temp_rolling_mean_6h FROM lg)"
    + f", tg AS (SELECT *, lead(ghi, 1) OVER ({_W}) AS target_ghi_next_1h, "
    + f"lead(temp, 1) OVER ({_W}) AS target_temp_next_1h FROM rl)"
    + ", feat AS (SELECT * FROM tg WHERE target_ghi_next_1h IS NOT NULL AND target_temp_next_1h IS NOT NULL)"
)


def _moment_cols() -> str:
    parts = []
    for i, c in enumerate(SCALED):
        x = f"CAST({c} AS {MOMENT})"
        parts += [f"count({c}) AS n{i}", f"sum({x}) AS sx{i}", f"sum(CAST({c} AS {WIDE}) * {x}) AS sxx{i}"]
    return ", ".join(parts)


def _mean(i):
    return f"CASE WHEN n{i} > 0 THEN CAST(sx{i} AS DOUBLE) / n{i} END"


def _std(i):
    sx = f"CAST(sx{i} AS DOUBLE)"
    return (
        f"CASE WHEN n{i} > 0 THEN sqrt(greatest((CAST(sxx{i} AS DOUBLE) - {sx} * {sx} / n{i}) / n{i}, "
        f"{S.dbl(0)})) END"
    )


CTE_PARAMS = CTE_FEATURES + f", mom AS (SELECT {_moment_cols()} FROM feat)"


def _scaled_select() -> str:
    cols = []
    for c in ["city", "ts", "ghi", "temp", "day_of_year", *CYC, *LAG_NAMES, *ROLL_NAMES, *TARGETS]:
        if c in SCALED:
            i = SCALED.index(c)
            sd = _std(i)
            cols.append(f"({c} - ({_mean(i)})) / (CASE WHEN ({sd}) IS NULL OR ({sd}) = 0 THEN 1.0 ELSE ({sd}) END) AS {c}")
        elif c in CYC:
            cols.append(f"round({c}, 9) AS {c}")
        else:
            cols.append(c)
    return ", ".join(cols)


# -- registered plans -------------------------------------------------------

@query(
    "gap_runs",
    "T2",
    f"WITH {S.CTE_SITES_GRID}, nb AS (SELECT city, ts, i, ghi, {_nb('ghi')} FROM grid) "
    "SELECT city, min(ts) AS run_start, max(ts) AS run_end, CAST(count(*) AS BIGINT) AS run_length, "
    f"count(*) > {IMP.short_gap_max} AS is_long, "
    "CASE WHEN coalesce(ghi_pi, -1) < 0 THEN 'leading' "
    "WHEN max(CASE WHEN ghi_ni IS NULL THEN 1 ELSE 0 END) = 1 THEN 'trailing' ELSE 'interior' END AS position "
    "FROM nb WHERE ghi IS NULL GROUP BY city, coalesce(ghi_pi, -1)",
    dates=(),
)
def gap_runs(spark, sf_dir):
    return TS.gap_runs(sites_grid(spark, sf_dir), "ghi", IMP.short_gap_max)


@query("impute_tiers", "T3 T4 T5 T6 B10", f"WITH {CTE_IMPUTED} SELECT * FROM imp", dates=())
def impute_tiers(spark, sf_dir):
    return imputed_sites(spark, sf_dir)


@query(
    "impute_counts",
    "T6 A28",
    f"WITH {CTE_IMPUTED}, b AS (SELECT city, CAST(count(*) AS BIGINT) AS grid_rows, "
    "CAST(count(*) FILTER (WHERE ghi IS NULL) + count(*) FILTER (WHERE temp IS NULL) AS BIGINT) AS missing_before "
    "FROM grid GROUP BY city), a AS (SELECT city, CAST(count(*) FILTER (WHERE ghi IS NULL) + "
    "count(*) FILTER (WHERE temp IS NULL) AS BIGINT) AS missing_after FROM imp GROUP BY city) "
    "SELECT city, grid_rows, missing_before, missing_after, missing_before - missing_after AS filled "
    "FROM b JOIN a USING (city)",
    dates=(),
)
def impute_counts(spark, sf_dir):
    grid = sites_grid(spark, sf_dir)
    return TS.impute_counts(grid, TS.impute(grid, IMP))


@query(
    "cyclical",
    "B3 B8",
    f"WITH {CTE_IMPUTED} SELECT city, ts, {_cyc_cols(9)} FROM imp",
    dates=(),
)
def cyclical(spark, sf_dir):
    imp = imputed_sites(spark, sf_dir).select("city", "ts")
    return _round_cyc(TS.with_cyclical(imp).drop())


@query("lags", "T7 J1", f"WITH {CTE_FEATURES} SELECT city, ts, {', '.join(LAG_NAMES)} FROM lg", dates=())
def lags(spark, sf_dir):
    imp = stored_grid(spark, sf_dir).select("city", "ts", "ghi", "temp")
    return TS.with_lags(imp).select("city", "ts", *LAG_NAMES)


@query("rolling", "T8", f"WITH {CTE_FEATURES} SELECT city, ts, {', '.join(ROLL_NAMES)} FROM rl", dates=())
def rolling(spark, sf_dir):
    imp = stored_grid(spark, sf_dir).select("city", "ts", "ghi", "temp")
    return TS.with_rolling(imp).select("city", "ts", *ROLL_NAMES)


@query("targets", "T9", f"WITH {CTE_FEATURES} SELECT city, ts, {', '.join(TARGETS)} FROM feat", dates=())
def targets(spark, sf_dir):
    imp = stored_grid(spark, sf_dir).select("city", "ts", "ghi", "temp")
    return TS.with_targets(imp).select("city", "ts", *TARGETS)


@query(
    "scaled_features",
    "T10",
    f"WITH {CTE_PARAMS} SELECT * FROM ("
    + " UNION ALL ".join(f"SELECT '{c}' AS feature, {_mean(i)} AS mean, {_std(i)} AS std FROM mom" for i, c in enumerate(SCALED))
    + ")",
    dates=(),
)
def scaled_features(spark, sf_dir):
    """T10 fitted parameters (one row per scaled column)."""
    return TS.scaler_params(features_unscaled(spark, sf_dir), SCALED)


@query(
    "feature_matrix",
    "T11 B1 T1 T6 B8 T7 T8 T9 T10",
    f"WITH {CTE_PARAMS} SELECT {_scaled_select()} FROM feat, mom",
    dates=(),
)
def feature_matrix_plan(spark, sf_dir):
    return _round_cyc(feature_matrix(spark, sf_dir))


def _corr_sql() -> str:
    parts = []
    for i, a in enumerate(CORR_COLS):
        for j, b in enumerate(CORR_COLS):
            if j < i:
                continue
            both = f"{a} IS NOT NULL AND {b} IS NOT NULL"
            xa = f"CASE WHEN {both} THEN {a} END"
            xb = f"CASE WHEN {both} THEN {b} END"
            r = (
                f"round(CASE WHEN stddev_pop({xa}) * stddev_pop({xb}) > 0 THEN "
                f"covar_pop({xa}, {xb}) / (stddev_pop({xa}) * stddev_pop({xb})) END, 9)"
            )
            parts.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, {r} AS r FROM feat")
            if a != b:
                parts.append(f"SELECT '{b}' AS col_a, '{a}' AS col_b, {r} AS r FROM feat")
    return f"WITH {CTE_FEATURES} {' UNION ALL '.join(parts)}"


@query("corr_matrix", "A19", _corr_sql(), dates=())
def corr_matrix(spark, sf_dir):
    return A.corr_matrix(features_unscaled(spark, sf_dir), CORR_COLS)


@query(
    "cyclical_integrity",
    "A29",
    f"WITH {CTE_FEATURES} SELECT "
    "max(abs(hour_sin * hour_sin + hour_cos * hour_cos - 1)) < 1e-12 AS hour_ok, "
    "max(abs(month_sin * month_sin + month_cos * month_cos - 1)) < 1e-12 AS month_ok, "
    "CAST(count(DISTINCT (round(hour_sin, 9), round(hour_cos, 9))) AS BIGINT) AS hour_points, "
    "CAST(count(DISTINCT (round(month_sin, 9), round(month_cos, 9))) AS BIGINT) AS month_points FROM feat",
    dates=(),
)
def cyclical_integrity(spark, sf_dir):
    df = A.cyclical_integrity(features_unscaled(spark, sf_dir))
    return df.select(
        (F.col("hour_max_dev") < 1e-12).alias("hour_ok"),
        (F.col("month_max_dev") < 1e-12).alias("month_ok"),
        "hour_points",
        "month_points",
    )


@query(
    "profile_counts",
    "A28",
    f"WITH {S.CTE_SITES_GRID} SELECT CAST(count(*) AS BIGINT) AS total_rows, "
    "CAST(count(DISTINCT city) AS BIGINT) AS distinct_cities, "
    "CAST(count(*) FILTER (WHERE ghi IS NULL) AS BIGINT) AS missing_ghi, "
    "CAST(count(*) FILTER (WHERE temp IS NULL) AS BIGINT) AS missing_temp FROM grid",
    dates=(),
)
def profile_counts(spark, sf_dir):
    return A.profile_counts(sites_grid(spark, sf_dir), ["ghi", "temp"])


def _sequence_sql(w: str) -> str:
    frame = f"OVER ({w} ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING)"
    return (
        f"WITH {S.CTE_DENSE}, {S.hourly_cte('dense', 'sh')}, "
        "q AS (SELECT city, ts, ghi, "
        f"count(*) {frame} AS seq_len, first_value(ghi) {frame} AS first_ghi, last_value(ghi) {frame} AS last_ghi, "
        f"CAST(sum(CAST(ghi AS {S.DEC})) {frame} AS DOUBLE) AS sum_ghi, CAST(sum(CAST(temp AS {S.DEC})) {frame} AS DOUBLE) AS sum_temp "
        "FROM sh) SELECT city, ts, CAST(seq_len AS BIGINT) AS seq_len, first_ghi, last_ghi, sum_ghi, sum_temp, "
        "ghi AS label FROM q WHERE seq_len = 24"
    )


def _digest(seq):
    dec, acc_t = "decimal(24,6)", "decimal(38,6)"
    return seq.select(
        "city",
        "ts",
        F.size("sequence").cast("bigint").alias("seq_len"),
        F.col("sequence")[0][0].alias("first_ghi"),
        F.col("sequence")[23][0].alias("last_ghi"),
        F.aggregate("sequence", F.lit(0).cast(acc_t), lambda acc, v: (acc + v[0].cast(dec)).cast(acc_t))
        .cast("double")
        .alias("sum_ghi"),
        F.aggregate("sequence", F.lit(0).cast(acc_t), lambda acc, v: (acc + v[1].cast(dec)).cast(acc_t))
        .cast("double")
        .alias("sum_temp"),
        F.col("label"),
    )


@query("sequence_digest", "T16", _sequence_sql(_W), dates=())
def sequence_digest(spark, sf_dir):
    """T16 on F1 hourly rows; digests of each 24-step input window."""
    return _digest(TS.sequences(TS.hourly_means(FX.dense(spark, sf_dir)), ["ghi", "temp"], "ghi", 24))


@query("sequence_digest_global", "T16", _sequence_sql("ORDER BY ts, city"), dates=())
def sequence_digest_global(spark, sf_dir):
    """T16 in global order: windows of 24 rows across cities, as they interleave by time."""
    return _digest(TS.sequences_global(TS.hourly_means(FX.dense(spark, sf_dir)), ["ghi", "temp"], "ghi", 24))


@query(
    "feature_roundtrip",
    "S7 S8 B2 B20 T11",
    f"WITH {CTE_PARAMS} SELECT {_scaled_select()}, CASE WHEN ts <= TIMESTAMP '{AS_OF_TS}' - INTERVAL 2 DAY "
    "THEN 'stable' ELSE 'recent' END AS slice FROM feat, mom",
    dates=(),
)
def feature_roundtrip(spark, sf_dir):
    """S7 sink (partitioned by city and stable/recent slice) and the S8
    reader with its guards (non-empty, every timestamp parseable)."""
    from ..session import shared_path
    from ..sources import ingest as I
    from ..sources.tables import read_features, write_features

    path = shared_path(spark, "features")
    write_features(I.stable_recent_split(feature_matrix_plan.__wrapped__(spark, sf_dir), AS_OF_TS, 2), path)
    return read_features(spark, path)
