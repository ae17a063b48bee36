"""Forecast-quality plans (A20-A27, M1, M5, F6 persistence forecasters)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import analytics as A
from ..operators import timeseries as TS
from ..sources import fixtures as FX
from . import sqltext as S
from .catalog import query
from .common import AS_OF, dense_hourly, stored_grid

LAGS = (1, 24)
KDE_POINTS = 64
TRAIN_FRACTION = 0.8
MOMENT = "DECIMAL(16,6)"
WIDE = "DECIMAL(19,6)"


def _q(x: str) -> str:
    return f"floor(({x}) * {S.dbl(1e6)} + {S.dbl(0.5)}) / {S.dbl(1e6)}"


# Long-form persistence predictions over "hourly".
CTE_PRED = (
    S.CTE_DENSE_HOURLY
    + ", shifted AS (SELECT city, ts + to_hours(CAST(l AS BIGINT)) AS ts, l AS lag, ghi AS p_ghi, temp AS p_temp "
    + f"FROM hourly, (SELECT unnest([{', '.join(str(k) for k in LAGS)}]) AS l) g)"
    + ", pairs AS (SELECT h.city, h.ts, s.lag, h.ghi, h.temp, s.p_ghi, s.p_temp FROM hourly h "
    + "JOIN shifted s ON h.city = s.city AND h.ts = s.ts)"
    + ", pred AS (SELECT 'persistence_' || CAST(lag AS VARCHAR) || 'h_GHI' AS model_name, 'GHI' AS target, city, ts, "
    + "ghi AS actual, p_ghi AS predicted FROM pairs UNION ALL SELECT 'persistence_' || CAST(lag AS VARCHAR) || "
    + "'h_Temp' AS model_name, 'Temp' AS target, city, ts, temp AS actual, p_temp AS predicted FROM pairs)"
)


def _metrics_sql(src: str, group: str) -> str:
    e = f"CAST({_q('predicted - actual')} AS {MOMENT})"
    ew = f"CAST({_q('predicted - actual')} AS {WIDE})"
    y = f"CAST({_q('actual')} AS {MOMENT})"
    yw = f"CAST({_q('actual')} AS {WIDE})"
    return (
        f"SELECT {group}, count(*) AS n, CAST(sum(abs({e})) AS DOUBLE) AS sae, CAST(sum({ew} * {e}) AS DOUBLE) AS see, "
        f"CAST(sum({y}) AS DOUBLE) AS sy, CAST(sum({yw} * {y}) AS DOUBLE) AS syy FROM {src} GROUP BY {group}"
    )


def _metrics_final(group: str) -> str:
    sst = "(syy - sy * sy / n)"
    return (
        f"SELECT {group}, sae / n AS mae, sqrt(see / n) AS rmse, CASE WHEN {sst} > 0 THEN 1.0 - see / {sst} END AS r2, "
        "CAST(n AS BIGINT) AS n FROM mm"
    )


def predictions(spark, sf_dir):
    return A.persistence_predictions(dense_hourly(spark, sf_dir), LAGS)


@query(
    "backtest_pairs",
    "A20 J3 B18",
    f"WITH {S.CTE_DENSE_HOURLY}, a AS (SELECT city, CAST(ts AS DATE) AS date, CAST(hour(ts) AS BIGINT) AS hour, "
    f"{S.rnd('ghi', 2)} AS actual_ghi FROM hourly), p AS (SELECT city, CAST(ts + INTERVAL 24 HOUR AS DATE) AS date, "
    f"CAST(hour(ts + INTERVAL 24 HOUR) AS BIGINT) AS hour, {S.rnd('ghi', 2)} AS predicted_ghi FROM hourly) "
    "SELECT a.city, a.date, a.hour, actual_ghi, predicted_ghi, abs(actual_ghi - predicted_ghi) AS abs_error, "
    "strftime(a.date, '%m-%d') || ' ' || lpad(CAST(a.hour AS VARCHAR), 2, '0') || 'h' AS label "
    "FROM a JOIN p ON a.city = p.city AND a.date = p.date AND a.hour = p.hour "
    f"WHERE a.date BETWEEN DATE '{AS_OF}' - 7 AND DATE '{AS_OF}' - 1",
)
def backtest_pairs(spark, sf_dir):
    return _pairs(spark, sf_dir)


def _pairs(spark, sf_dir):
    # A week and the day that its first predictions come from; the bounds reach the scan.
    last = F.lit(AS_OF).cast("timestamp")
    week = FX.dense(spark, sf_dir).filter((F.col("ts") >= F.timestamp_add("DAY", F.lit(-8), last)) & (F.col("ts") < last))
    h = TS.hourly_means(week)
    predicted = h.select("city", F.timestamp_add("HOUR", F.lit(24), F.col("ts")).alias("ts"), "ghi")
    return A.backtest_pairs(h, predicted, AS_OF, 7)


@query(
    "backtest_daily",
    "A21",
    f"WITH {S.CTE_DENSE_HOURLY}, a AS (SELECT city, CAST(ts AS DATE) AS date, hour(ts) AS hour, "
    f"{S.rnd('ghi', 2)} AS actual_ghi FROM hourly), p AS (SELECT city, CAST(ts + INTERVAL 24 HOUR AS DATE) AS date, "
    f"hour(ts + INTERVAL 24 HOUR) AS hour, {S.rnd('ghi', 2)} AS predicted_ghi FROM hourly), "
    "e AS (SELECT a.city, a.date, CAST(abs(actual_ghi - predicted_ghi) AS DECIMAL(20,2)) AS e "
    "FROM a JOIN p ON a.city = p.city AND a.date = p.date AND a.hour = p.hour "
    f"WHERE a.date BETWEEN DATE '{AS_OF}' - 7 AND DATE '{AS_OF}' - 1) "
    "SELECT city, date, CAST(sum(e) AS DOUBLE) / count(*) AS mae, sqrt(CAST(sum(e * e) AS DOUBLE) / count(*)) AS rmse, "
    "CAST(count(*) AS BIGINT) AS points FROM e GROUP BY 1, 2",
)
def backtest_daily(spark, sf_dir):
    return A.backtest_daily(_pairs(spark, sf_dir))


@query(
    "model_metrics",
    "A22 A24 S10",
    f"WITH {CTE_PRED}, mm AS ({_metrics_sql('pred', 'model_name, target')}) {_metrics_final('model_name, target')}",
    dates=(),
)
def model_metrics(spark, sf_dir):
    return A.regression_metrics(predictions(spark, sf_dir), ["model_name", "target"])


@query(
    "model_comparison",
    "A23 J2",
    f"WITH {CTE_PRED}, g AS (SELECT city, ts, max(actual) AS actual, "
    "max(CASE WHEN model_name = 'persistence_1h_GHI' THEN predicted END) AS persistence_1h, "
    "max(CASE WHEN model_name = 'persistence_24h_GHI' THEN predicted END) AS persistence_24h "
    "FROM pred WHERE target = 'GHI' GROUP BY city, ts) SELECT city, ts, actual, persistence_1h, persistence_24h, "
    "persistence_1h - actual AS residual_1h, persistence_24h - actual AS residual_24h FROM g "
    "WHERE persistence_1h IS NOT NULL AND persistence_24h IS NOT NULL",
    dates=(),
)
def model_comparison(spark, sf_dir):
    """Per-timestamp actual and each model's prediction, aligned after warm-up."""
    p = predictions(spark, sf_dir).filter(F.col("target") == "GHI")
    g = p.groupBy("city", "ts").agg(
        F.max("actual").alias("actual"),
        F.max(F.when(F.col("model_name") == "persistence_1h_GHI", F.col("predicted"))).alias("persistence_1h"),
        F.max(F.when(F.col("model_name") == "persistence_24h_GHI", F.col("predicted"))).alias("persistence_24h"),
    )
    return g.filter(F.col("persistence_1h").isNotNull() & F.col("persistence_24h").isNotNull()).select(
        "*",
        (F.col("persistence_1h") - F.col("actual")).alias("residual_1h"),
        (F.col("persistence_24h") - F.col("actual")).alias("residual_24h"),
    )


def _kde_sql() -> str:
    x = f"CAST({_q('residual')} AS {MOMENT})"
    xw = f"CAST({_q('residual')} AS {WIDE})"
    per, unit = A.KDE_BINS_PER_STEP, S.dbl(float(1 << 20))
    last = (KDE_POINTS - 1) * per
    return (
        f"WITH {CTE_PRED}, r AS (SELECT model_name, predicted - actual AS residual FROM pred), "
        f"st AS (SELECT model_name, count({x}) AS n, CAST(sum({x}) AS DOUBLE) AS sx, CAST(sum({xw} * {x}) AS DOUBLE) AS sxx, "
        "min(residual) AS lo, max(residual) AS hi FROM r GROUP BY 1), "
        f"st2 AS (SELECT model_name, n, lo, hi, sqrt(greatest((sxx - sx * sx / n) / (n - 1), {S.dbl(0)})) * "
        f"pow(CAST(n AS DOUBLE), {S.dbl(-0.2)}) AS h FROM st WHERE n >= 2), "
        f"st3 AS (SELECT model_name, n, h, lo - {S.dbl(3)} * h AS x0, (hi - lo + {S.dbl(6)} * h) / {S.dbl(last)} AS w FROM st2 WHERE h > 0), "
        "p AS (SELECT model_name, n, h, x0, w, (residual - x0) / w AS p FROM r JOIN st3 USING (model_name) WHERE residual IS NOT NULL), "
        f"b AS (SELECT *, least(CAST(floor(p) AS BIGINT), {last - 1}) AS bin FROM p), "
        f"c AS (SELECT model_name, n, h, x0, w, bin, count(*) AS c, CAST(sum(CAST(floor((p - bin) * {unit} + {S.dbl(0.5)}) AS BIGINT)) AS BIGINT) AS up "
        "FROM b GROUP BY ALL), "
        f"m AS (SELECT model_name, n, h, x0, w, bin AS j, c * {1 << 20} - up AS m FROM c UNION ALL SELECT model_name, n, h, x0, w, bin + 1, up FROM c), "
        f"g AS (SELECT model_name, n, h, x0, w, k, sum(CAST(m AS DOUBLE) * exp({S.dbl(-0.5)} * ((k * {per} - j) * w / h) * ((k * {per} - j) * w / h))) AS t "
        f"FROM m, range(0, {KDE_POINTS}) q(k) GROUP BY ALL) "
        f"SELECT model_name, CAST(k AS BIGINT) AS grid_idx, round(x0 + k * {per} * w, 6) AS x, "
        f"round(t / (n * h * {S.dbl((2.0 * 3.141592653589793) ** 0.5)} * {unit}), 10) AS density FROM g"
    )


@query("residual_density", "A25", _kde_sql(), dates=())
def residual_density(spark, sf_dir):
    r = predictions(spark, sf_dir).select("model_name", (F.col("predicted") - F.col("actual")).alias("residual"))
    d = A.residual_density(r, ["model_name"], "residual", KDE_POINTS)
    return d.select("model_name", "grid_idx", F.round("x", 6).alias("x"), F.round("density", 10).alias("density"))


@query(
    "model_rank",
    "A26",
    f"WITH {CTE_PRED}, mm AS ({_metrics_sql('pred', 'model_name, target')}), m AS ({_metrics_final('model_name, target')}), "
    "f AS (SELECT *, CASE WHEN contains(model_name, 'GHI') THEN 'GHI' WHEN contains(model_name, 'Temp') THEN 'Temp' END "
    "AS family FROM m) SELECT family, model_name, mae, rmse, r2, "
    "CAST(row_number() OVER (PARTITION BY family ORDER BY mae, model_name) AS BIGINT) AS rank, "
    "row_number() OVER (PARTITION BY family ORDER BY mae, model_name) = 1 AS is_champion, "
    "CASE WHEN max(mae) OVER (PARTITION BY family) > 0 THEN mae / max(mae) OVER (PARTITION BY family) * 100 ELSE 0.0 END "
    "AS mae_bar_pct, CASE WHEN max(rmse) OVER (PARTITION BY family) > 0 THEN rmse / max(rmse) OVER (PARTITION BY family) "
    "* 100 ELSE 0.0 END AS rmse_bar_pct FROM f WHERE family IS NOT NULL",
    dates=(),
)
def model_rank(spark, sf_dir):
    m = A.regression_metrics(predictions(spark, sf_dir), ["model_name", "target"])
    return A.model_rank(m)


def _period_sql() -> str:
    return (
        f"CASE WHEN CAST(ts AS DATE) < DATE '{AS_OF}' - 7 THEN 'stable' "
        f"WHEN CAST(ts AS DATE) < DATE '{AS_OF}' THEN 'recent' END"
    )


@query(
    "promotion_gate",
    "M5 D6",
    f"WITH {CTE_PRED}, pp AS (SELECT *, {_period_sql()} AS period FROM pred), "
    f"mm AS ({_metrics_sql('pp WHERE period IS NOT NULL', 'period, model_name, target')}), "
    f"m AS ({_metrics_final('period, model_name, target')}), "
    "champ AS (SELECT target, model_name AS champion_model, rmse AS champion_rmse FROM m "
    "WHERE period = 'stable' AND model_name LIKE 'persistence_24h_%'), "
    "cand AS (SELECT target, model_name AS candidate_model, rmse AS candidate_rmse, "
    "row_number() OVER (PARTITION BY target ORDER BY rmse, model_name) AS rn FROM m WHERE period = 'recent') "
    "SELECT c.target, candidate_model, candidate_rmse, champion_model, champion_rmse, "
    "(champion_rmse IS NULL OR candidate_rmse < champion_rmse) AS promote FROM cand c "
    "LEFT JOIN champ USING (target) WHERE rn = 1",
    dates=(),
)
def promotion_gate(spark, sf_dir):
    """M5 (keyed by target): best recent candidate vs. the incumbent's RMSE."""
    from ..operators.models import promotion_gate as gate

    as_of = F.lit(AS_OF).cast("date")
    p = predictions(spark, sf_dir).withColumn(
        "period",
        F.when(F.to_date("ts") < F.date_sub(as_of, 7), F.lit("stable")).when(F.to_date("ts") < as_of, F.lit("recent")),
    )
    m = A.regression_metrics(p.filter(F.col("period").isNotNull()), ["period", "model_name", "target"])
    champion = m.filter((F.col("period") == "stable") & F.col("model_name").startswith("persistence_24h_"))
    candidates = m.filter(F.col("period") == "recent")
    return gate(candidates, champion)


@query(
    "chrono_split",
    "M1",
    f"WITH {S.CTE_DENSE_HOURLY}, r AS (SELECT city, ts, row_number() OVER (ORDER BY ts, city) - 1 AS row_index, "
    "count(*) OVER () AS n FROM hourly) SELECT city, ts, CAST(row_index AS BIGINT) AS row_index, "
    f"CASE WHEN row_index < CAST(floor(n * {TRAIN_FRACTION}) AS BIGINT) THEN 'train' ELSE 'test' END AS split FROM r",
    dates=(),
)
def chrono_split(spark, sf_dir):
    """M1: first int(0.8 n) rows by (ts, city) train, rest test (global order,
    computed with range partitions -- no single-partition window)."""
    from ..operators.models import chronological_split

    return chronological_split(dense_hourly(spark, sf_dir).select("city", "ts"), ["ts", "city"], TRAIN_FRACTION)


# -- boosted trees (M2-M4, M6, A27, S10, S11): rows-only checks ------------------


TARGETS = {"GHI": "target_ghi_next_1h", "Temp": "target_temp_next_1h"}


def training_frame(spark, sf_dir):
    """B26 matrix with both targets, split by time (M1): (frame, features)."""
    from ..operators import clean as C
    from ..operators import models as M

    feats = TS.with_features(stored_grid(spark, sf_dir, FX.dense, "dense_grid").select("city", "ts", "ghi", "temp"))
    feats = TS.apply_scaler(feats, TS.scaler_params(feats, TS.scaled_columns(feats.columns)))
    cats = C.categories_of(FX.dense(spark, sf_dir).select("city"))
    numeric = [c for c, t in feats.dtypes if t in ("double", "bigint", "int") and not c.startswith("target_")]
    matrix = C.model_matrix(feats, cats, numeric, labels=tuple(TARGETS.values()))
    return M.chronological_split(matrix, ["ts", "city"], TRAIN_FRACTION), ["epoch_seconds", *[f"city_{c}" for c in cats], *numeric]


def trained_models(spark, sf_dir, split, features):
    """M6: one boosted-tree model a target, trained once for these inputs and
    parameters, saved, and loaded for every use."""
    from ..config import HOURLY_TREE_PARAMS
    from ..operators import models as M
    from ..sources.grid_store import input_state
    from ..sources.model_store import saved_models

    state = f"{input_state(FX.dense(spark, sf_dir))}-{HOURLY_TREE_PARAMS}"
    names = {t: f"boosted_trees_{t}-{state}" for t in TARGETS}
    return saved_models(spark, names, lambda targets: M.train_targets(split, features, {t: TARGETS[t] for t in targets}, HOURLY_TREE_PARAMS))


@query("gbt_train_score", "M1 M2 M3 M6 A22 S10")
def gbt_train_score(spark, sf_dir):
    """Holdout metrics of the boosted-tree models (one row per target)."""
    from ..operators import models as M

    split, features = training_frame(spark, sf_dir)
    models = trained_models(spark, sf_dir, split, features)
    found = [M.evaluate(models[t], split, label, f"boosted_trees_{t}")[1].withColumn("target", F.lit(t)) for t, label in TARGETS.items()]
    return found[0].unionByName(found[1]).select("model_name", "target", "mae", "rmse", "r2", "n", "n_train")


@query("feature_importance", "M4 A27 S11")
def feature_importance(spark, sf_dir):
    """Importance ranking of the GHI model's features, written as a table, read
    back, in percent and with ranks."""
    from ..operators import models as M
    from ..session import shared_path
    from ..sources.tables import write_importances

    split, features = training_frame(spark, sf_dir)
    model = trained_models(spark, sf_dir, split, features)["GHI"]
    path = shared_path(spark, "importances")
    write_importances(M.feature_importances(spark, model, features), path)
    return A.importance_rank(spark.read.parquet(path))


@query(
    "holdout_predictions",
    "S11 M1 M3",
    f"WITH {CTE_PRED}, r AS (SELECT *, row_number() OVER (PARTITION BY model_name ORDER BY ts, city) - 1 AS i, "
    "count(*) OVER (PARTITION BY model_name) AS n FROM pred) SELECT model_name, city, ts, actual, predicted, actual - predicted AS residual "
    f"FROM r WHERE i >= CAST(floor(n * {TRAIN_FRACTION}) AS BIGINT)",
    dates=(),
)
def holdout_predictions(spark, sf_dir):
    """Predictions of the persistence models on each one's last fifth of rows,
    written as the holdout table and read back."""
    from ..operators import models as M
    from ..session import shared_path
    from ..sources.tables import write_holdout

    path = shared_path(spark, "holdout")
    parts = []
    for name in [f"persistence_{k}h_{t}" for k in LAGS for t in ("GHI", "Temp")]:
        own = predictions(spark, sf_dir).where(F.col("model_name") == name)
        parts.append(M.chronological_split(own, ["ts", "city"], TRAIN_FRACTION).where("split = 'test'"))
    test = parts[0]
    for p in parts[1:]:
        test = test.unionByName(p)
    write_holdout(test.select("model_name", "city", "ts", "actual", "predicted"), path)
    return spark.read.parquet(path).select("model_name", "city", "ts", "actual", "predicted", "residual")
