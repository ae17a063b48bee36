"""Station plans (S9, B4-B7, B9, T12-T15, B27) over the F7 per-file view."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import STATION_GHI_LAGS, STATION_TREE_PARAMS
from ..operators import station as ST
from ..sources import fixtures as FX
from ..session import shared_path
from ..sources import station as SS
from . import sqltext as S
from .catalog import query

NUM = ["temperature", "humidity", "wind_direction", "wind_speed", "wind_gust", "pressure", "ghi"]


def station_frame(spark, sf_dir):
    return SS.harmonise(FX.station_files(spark, sf_dir), row_col="_row")


_EV = (
    "ev AS (SELECT event_id, event_type, date_trunc('second', ts) AS t, round(value * 8, 4) AS ghi, "
    "CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, value, "
    "CAST(100 + 3 * CAST(json_extract_string(props, '$.k') AS INTEGER) AS DOUBLE) / 10 AS temp FROM events)"
)
_N = "CAST(NULL AS DOUBLE)"
_ST = (
    f"{_EV}, st0 AS ("
    f"SELECT t AS timestamp, temp AS temperature, CAST(k AS DOUBLE) AS humidity, {_N} AS wind_direction, "
    f"value / 10 AS wind_speed, {_N} AS wind_gust, {_N} AS pressure, ghi, 'station_click.csv' AS source_file, "
    "event_id AS _row FROM ev WHERE event_type = 'click' UNION ALL "
    f"SELECT t, temp, {_N}, {_N}, {_N}, {_N}, CAST(900 + k AS DOUBLE), ghi, 'station_error.csv', event_id "
    "FROM ev WHERE event_type = 'error' UNION ALL "
    f"SELECT t, temp, {_N}, {_N}, value / 10, value / 5, {_N}, ghi, 'station_purchase.csv', event_id "
    "FROM ev WHERE event_type = 'purchase' UNION ALL "
    f"SELECT t, {_N}, CAST(k AS DOUBLE), k * {S.dbl(3.6)}, {_N}, {_N}, {_N}, CASE WHEN k = 0 THEN NULL ELSE ghi END, "
    "'station_signup.csv', event_id FROM ev WHERE event_type = 'signup'), "
    "st AS (SELECT * FROM st0 WHERE ghi IS NOT NULL AND timestamp IS NOT NULL)"
)


def _interp(c: str, part: str = "") -> str:
    back = f"OVER ({part}ORDER BY g ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    fwd = f"OVER ({part}ORDER BY g ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    return (
        f"max(CASE WHEN {c} IS NOT NULL THEN g END) {back} AS {c}_pi, last_value({c} IGNORE NULLS) {back} AS {c}_pv, "
        f"min(CASE WHEN {c} IS NOT NULL THEN g END) {fwd} AS {c}_ni, first_value({c} IGNORE NULLS) {fwd} AS {c}_nv"
    )


def _filled(c: str) -> str:
    return (
        f"CASE WHEN {c} IS NOT NULL THEN {c} WHEN {c}_pi IS NOT NULL AND {c}_ni IS NOT NULL THEN "
        f"({c}_nv - {c}_pv) / ({c}_ni - {c}_pi) * (g - {c}_pi) + {c}_pv WHEN {c}_pi IS NOT NULL THEN {c}_pv "
        f"ELSE {c}_nv END AS {c}"
    )


def _q(x: str) -> str:
    return f"floor(({x}) * {S.dbl(1e6)} + {S.dbl(0.5)}) / {S.dbl(1e6)}"


_TWO_PI = S.dbl(2 * 3.141592653589793)


def _station_cte(key: str = "") -> str:
    """All files as one series, or a series for each value of ``key``."""
    part = f"PARTITION BY {key} " if key else ""
    also = f"{key}, " if key else ""
    w = f"OVER ({part}ORDER BY timestamp)"
    w3 = f"OVER ({part}ORDER BY timestamp ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)"
    return (
        _ST
        + f", ix AS (SELECT *, row_number() OVER ({part}ORDER BY timestamp, source_file, _row) - 1 AS g FROM st)"
        + ", nb AS (SELECT *, " + ", ".join(_interp(c, part) for c in NUM) + " FROM ix)"
        + f", fi AS (SELECT {also}timestamp, " + ", ".join(_filled(c) for c in NUM) + " FROM nb)"
        + f", co AS (SELECT {also}timestamp, "
        + ", ".join(S.qmean(f"sum(CAST({_q(c)} AS {S.DEC}))", f"count({_q(c)})") + f" AS {c}" for c in NUM)
        + f" FROM fi GROUP BY {also}timestamp)"
        + ", fe AS (SELECT *, CAST(hour(timestamp) AS BIGINT) AS hour, CAST(dayofyear(timestamp) AS BIGINT) AS day_of_year, "
        + "CAST(month(timestamp) AS BIGINT) AS month, "
        + f"sin({_TWO_PI} * hour(timestamp) / {S.dbl(24)}) AS hour_sin, cos({_TWO_PI} * hour(timestamp) / {S.dbl(24)}) AS hour_cos, "
        + f"sin({_TWO_PI} * dayofyear(timestamp) / {S.dbl(365.25)}) AS doy_sin, "
        + f"cos({_TWO_PI} * dayofyear(timestamp) / {S.dbl(365.25)}) AS doy_cos, "
        + ", ".join(f"lag(ghi, {k}) {w} AS ghi_lag_{k}" for k in STATION_GHI_LAGS)
        + f", lag(temperature, 1) {w} AS temp_lag_1, "
        + S.qmean(f"sum(CAST(ghi AS {S.DEC})) {w3}", f"count(ghi) {w3}")
        + " AS ghi_rolling_mean_3h, "
        + f"CASE WHEN count(ghi) {w3} >= 2 THEN floor(sqrt(greatest((CAST(sum(CAST(ghi AS DECIMAL(19,6)) * "
        + f"CAST(ghi AS DECIMAL(16,6))) {w3} AS DOUBLE) - CAST(sum(CAST(ghi AS DECIMAL(16,6))) {w3} AS DOUBLE) * "
        + f"CAST(sum(CAST(ghi AS DECIMAL(16,6))) {w3} AS DOUBLE) / count(ghi) {w3}) / (count(ghi) {w3} - 1), "
        + f"{S.dbl(0)})) * {S.dbl(1e6)} + {S.dbl(0.5)}) / {S.dbl(1e6)} END AS ghi_rolling_std_3h, "
        + f"lead(ghi, 1) {w} AS target_ghi_next_1h, lead(temperature, 1) {w} AS target_temperature_next_1h FROM co)"
    )


CTE_STATION = _station_cte()

_OUT = (
    ["timestamp", *NUM, "hour", "day_of_year", "month", "hour_sin", "hour_cos", "doy_sin", "doy_cos"]
    + [f"ghi_lag_{k}" for k in STATION_GHI_LAGS]
    + ["temp_lag_1", "ghi_rolling_mean_3h", "ghi_rolling_std_3h", "target_ghi_next_1h", "target_temperature_next_1h"]
)
_CYC = ("hour_sin", "hour_cos", "doy_sin", "doy_cos")


def _out_sql(c: str) -> str:
    if c == "timestamp":
        return c
    if c in ("hour", "day_of_year", "month"):
        return c
    e = f"round({c}, 9)" if c in _CYC else c
    return f"coalesce({e}, {S.dbl(0)}) AS {c}"


@query(
    "station_features",
    "S9 B4 B5 B6 B7 B9 T12 T13 T14 T15 B27 U1",
    f"WITH {CTE_STATION} SELECT {', '.join(_out_sql(c) for c in _OUT)} FROM fe "
    "WHERE target_ghi_next_1h IS NOT NULL AND target_temperature_next_1h IS NOT NULL",
    dates=(),
)
def station_features(spark, sf_dir):
    f = ST.station_features(station_frame(spark, sf_dir))
    return f.select(*[F.round(c, 9).alias(c) if c in _CYC else F.col(c) for c in _OUT])


@query(
    "station_harmonised",
    "S9 B4 B5 B6 B7 U1",
    f"WITH {_ST} SELECT timestamp, {', '.join(NUM)}, source_file FROM st",
    dates=(),
)
def station_harmonised(spark, sf_dir):
    st = station_frame(spark, sf_dir)
    return st.select("timestamp", *NUM, "source_file")


@query(
    "station_files_landed",
    "S9 B4 B5 B6 B7 U1",
    f"WITH {_ST} SELECT timestamp, {', '.join(NUM)} FROM st",
    dates=(),
)
def station_files_landed(spark, sf_dir):
    """The station views written out as CSV files, many of each header, and
    read back: one scan a header, whatever the number of files."""
    root = shared_path(spark, "station-files")
    for name, frame in FX.station_files(spark, sf_dir).items():
        frame.drop("_row").repartition(40).write.option("header", "true").csv(f"{root}/{name}")
    paths = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv").text(root).inputFiles()
    return SS.read_station_files(spark, paths).select("timestamp", *NUM)


@query(
    "station_features_per_file",
    "T14 T12 T13 T15 B9 B27",
    f"WITH {_station_cte('source_file')} SELECT source_file, {', '.join(_out_sql(c) for c in _OUT)} FROM fe "
    "WHERE target_ghi_next_1h IS NOT NULL AND target_temperature_next_1h IS NOT NULL",
    dates=(),
)
def station_features_per_file(spark, sf_dir):
    """The station frame with every file a series of its own."""
    f = ST.station_features(station_frame(spark, sf_dir), global_order=False)
    return f.select("source_file", *[F.round(c, 9).alias(c) if c in _CYC else F.col(c) for c in _OUT])


STATION_TARGETS = {"ghi": "target_ghi_next_1h", "temperature": "target_temperature_next_1h"}


@query(
    "station_target_selection",
    "B28 T15",
    f"WITH {CTE_STATION}, f AS (SELECT {', '.join(_out_sql(c) for c in _OUT)} FROM fe WHERE target_ghi_next_1h IS NOT NULL "
    "AND target_temperature_next_1h IS NOT NULL) "
    + " UNION ALL ".join(
        f"SELECT '{mode}' AS mode, timestamp, {len(_OUT) - 3} AS n_features, {target} AS target, ghi_lag_24 + humidity AS probe FROM f"
        for mode, target in STATION_TARGETS.items()
    ),
    dates=(),
)
def station_target_selection(spark, sf_dir):
    """Target mode ``both``: the training rows of each target in turn."""
    from ..operators import clean as C

    feats = ST.station_features(station_frame(spark, sf_dir))
    out = None
    for mode, (features, label) in C.selections(feats, "both", STATION_TARGETS).items():
        chosen = feats.select("timestamp", *features, F.col(label).alias("target"))
        rows = chosen.select(
            F.lit(mode).alias("mode"), "timestamp", F.lit(len(features)).alias("n_features"), "target", (F.col("ghi_lag_24") + F.col("humidity")).alias("probe")
        )
        out = rows if out is None else out.unionByName(rows)
    return out


def station_training_frame(spark, sf_dir):
    """The station frame split by time: (frame, selections of both targets)."""
    from ..operators import clean as C
    from ..operators import models as M

    feats = ST.station_features(station_frame(spark, sf_dir))
    return M.chronological_split(feats, ["timestamp"], 0.8), C.selections(feats, "both", STATION_TARGETS)


def station_models(spark, sf_dir, split, chosen, params=STATION_TREE_PARAMS):
    """M6 on the station frame with the station hyper-parameters, both targets
    fitted side by side, saved and loaded."""
    from ..operators import models as M
    from ..sources.grid_store import input_state
    from ..sources.model_store import saved_models

    state = f"{input_state(FX.events_raw(spark, sf_dir))}-{params}"
    features = chosen["ghi"][0]
    names = {t: f"station_boosted_{t}-{state}" for t in chosen}
    return saved_models(spark, names, lambda targets: M.train_targets(split, features, {t: chosen[t][1] for t in targets}, params))


@query("station_train_score", "M2 M6 B28 S10 M3")
def station_train_score(spark, sf_dir):
    """Holdout metrics of the station models of both targets, of all the trees
    of the station parameters, from the saved pipelines."""
    from ..operators import models as M

    split, chosen = station_training_frame(spark, sf_dir)
    models = station_models(spark, sf_dir, split, chosen)
    found = [M.evaluate(models[t], split, label, f"station_boosted_{t}")[1].withColumn("target", F.lit(t)) for t, (_, label) in chosen.items()]
    return found[0].unionByName(found[1])
