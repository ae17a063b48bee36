"""Operators the reference documents but does not implement."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import analytics as A
from ..operators.quantiles import exact_quantiles
from ..sources import fixtures as FX
from . import sqltext as S
from .catalog import query
from .common import AS_OF, AS_OF_TS, dense_hourly
from .q_forecast import CTE_PRED, _metrics_final, _metrics_sql, predictions

PSI_BIN = 100.0
PSI_EPS = 1e-6
GATE_IMPROVEMENT = 0.02


@query(
    "data_quality_report",
    "D1",
    f"WITH {S.CTE_DENSE}, q AS (SELECT city, quantile_cont(ghi, 0.25) AS q1, quantile_cont(ghi, 0.75) AS q3, "
    "count(*) AS n, count(*) FILTER (WHERE ghi IS NULL) AS mg, count(*) FILTER (WHERE temp IS NULL) AS mt FROM dense GROUP BY 1), "
    "d AS (SELECT city, count(*) FILTER (WHERE c > 1) AS v FROM (SELECT city, date_trunc('hour', ts) AS h, count(*) AS c "
    "FROM dense GROUP BY 1, 2) k GROUP BY 1), o AS (SELECT r.city, count(*) FILTER (WHERE ghi < q1 - 1.5::DOUBLE * (q3 - q1) "
    "OR ghi > q3 + 1.5::DOUBLE * (q3 - q1)) AS v FROM dense r JOIN q USING (city) GROUP BY 1) "
    'SELECT q.city, CAST(n AS BIGINT) AS "rows", CAST(mg AS BIGINT) AS missing_ghi, CAST(mt AS BIGINT) AS missing_temp, q1 AS ghi_q1, q3 AS ghi_q3, '
    "CAST(d.v AS BIGINT) AS duplicate_hours, CAST(o.v AS BIGINT) AS ghi_outliers FROM q JOIN d USING (city) JOIN o USING (city)",
    dates=(),
)
def data_quality_report(spark, sf_dir):
    """Per city: rows, missing cells, duplicate hour keys, exact quartiles and
    the values outside 1.5 interquartile ranges."""
    raw = FX.dense(spark, sf_dir)
    found = exact_quantiles(raw, "city", "ghi", [0.25, 0.75])
    quartiles = found.groupBy("city").agg(
        F.max(F.when(F.col("prob") == 0.25, F.col("quantile"))).alias("ghi_q1"),
        F.max(F.when(F.col("prob") == 0.75, F.col("quantile"))).alias("ghi_q3"),
    )
    counts = raw.groupBy("city").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("ghi").isNull()).alias("missing_ghi"),
        F.count_if(F.col("temp").isNull()).alias("missing_temp"),
    )
    dup = (
        raw.groupBy("city", F.date_trunc("hour", "ts").alias("h"))
        .count()
        .groupBy("city")
        .agg(F.count_if(F.col("count") > 1).alias("duplicate_hours"))
    )
    reach = F.lit(1.5) * (F.col("ghi_q3") - F.col("ghi_q1"))
    outside = (F.col("ghi") < F.col("ghi_q1") - reach) | (F.col("ghi") > F.col("ghi_q3") + reach)
    out = raw.join(quartiles, "city").groupBy("city").agg(F.count_if(outside).alias("ghi_outliers"))
    return counts.join(quartiles, "city").join(dup, "city").join(out, "city")


def _psi_sql() -> str:
    per = (
        f"CASE WHEN ts <= TIMESTAMP '{AS_OF_TS}' - INTERVAL 7 DAY THEN 'reference' "
        f"WHEN ts <= TIMESTAMP '{AS_OF_TS}' THEN 'current' END"
    )
    return (
        f"WITH {S.CTE_DENSE_HOURLY}, p AS (SELECT city, {per} AS period, CAST(floor(ghi / {S.dbl(PSI_BIN)}) AS BIGINT) AS bin "
        "FROM hourly), c AS (SELECT city, bin, count(*) FILTER (WHERE period = 'reference') AS nr, "
        "count(*) FILTER (WHERE period = 'current') AS nc FROM p WHERE period IS NOT NULL GROUP BY 1, 2), "
        "t AS (SELECT city, bin, nr, nc, sum(nr) OVER (PARTITION BY city) AS tr, sum(nc) OVER (PARTITION BY city) AS tc "
        f"FROM c), f AS (SELECT city, greatest(nr / tr, {S.dbl(PSI_EPS)}) AS pr, greatest(nc / tc, {S.dbl(PSI_EPS)}) AS pc "
        "FROM t WHERE tr > 0 AND tc > 0) SELECT city, round(sum((pc - pr) * ln(pc / pr)), 9) AS psi, "
        "CAST(count(*) AS BIGINT) AS bins FROM f GROUP BY city"
    )


@query("drift_psi", "D2", _psi_sql(), dates=())
def drift_psi(spark, sf_dir):
    """Population stability of hourly GHI: last 7 days vs. everything before,
    fixed 100 W/m^2 bins, per city."""
    h = dense_hourly(spark, sf_dir)
    t0 = F.lit(AS_OF_TS).cast("timestamp")
    period = F.when(F.col("ts") <= F.timestamp_add("DAY", F.lit(-7), t0), F.lit("reference")).when(
        F.col("ts") <= t0, F.lit("current")
    )
    c = (
        h.select("city", period.alias("period"), F.floor(F.col("ghi") / PSI_BIN).cast("bigint").alias("bin"))
        .filter(F.col("period").isNotNull())
        .groupBy("city", "bin")
        .agg(F.count_if(F.col("period") == "reference").alias("nr"), F.count_if(F.col("period") == "current").alias("nc"))
    )
    w = Window.partitionBy("city")  # one row per (city, bin): bounded by the bin count
    t = c.select("*", F.sum("nr").over(w).alias("tr"), F.sum("nc").over(w).alias("tc")).filter(
        (F.col("tr") > 0) & (F.col("tc") > 0)
    )
    f = t.select(
        "city",
        F.greatest(F.col("nr") / F.col("tr"), F.lit(PSI_EPS)).alias("pr"),
        F.greatest(F.col("nc") / F.col("tc"), F.lit(PSI_EPS)).alias("pc"),
    )
    return f.groupBy("city").agg(
        F.round(F.sum((F.col("pc") - F.col("pr")) * F.log(F.col("pc") / F.col("pr"))), 9).alias("psi"),
        F.count(F.lit(1)).cast("bigint").alias("bins"),
    )


@query(
    "chrono_split_3way",
    "D5 M1",
    f"WITH {S.CTE_DENSE_HOURLY}, r AS (SELECT city, ts, row_number() OVER (ORDER BY ts, city) - 1 AS row_index, "
    "count(*) OVER () AS n FROM hourly) SELECT city, ts, CAST(row_index AS BIGINT) AS row_index, "
    "CASE WHEN row_index < CAST(floor(n * 0.7) AS BIGINT) THEN 'train' "
    "WHEN row_index < CAST(floor(n * 0.85) AS BIGINT) THEN 'validation' ELSE 'test' END AS split FROM r",
    dates=(),
)
def chrono_split_3way(spark, sf_dir):
    """70 / 15 / 15 chronological split over the global (ts, city) order."""
    from ..operators.global_order import with_global_index

    idx = with_global_index(dense_hourly(spark, sf_dir).select("city", "ts"), ["ts", "city"], "row_index")
    n = F.col("_total")
    split = (
        F.when(F.col("row_index") < F.floor(n * 0.7).cast("bigint"), F.lit("train"))
        .when(F.col("row_index") < F.floor(n * 0.85).cast("bigint"), F.lit("validation"))
        .otherwise(F.lit("test"))
    )
    return idx.select("city", "ts", F.col("row_index").cast("bigint").alias("row_index"), split.alias("split"))


@query(
    "challenger_gate",
    "D6 M5 A21",
    f"WITH {CTE_PRED}, pp AS (SELECT * FROM pred WHERE CAST(ts AS DATE) >= DATE '{AS_OF}' - 7 "
    f"AND CAST(ts AS DATE) < DATE '{AS_OF}'), mm AS ({_metrics_sql('pp', 'model_name, target')}), "
    f"m AS ({_metrics_final('model_name, target')}) SELECT ch.target, ch.model_name AS champion_model, "
    "ch.mae AS champion_mae, c.model_name AS challenger_model, c.mae AS challenger_mae, "
    f"c.mae <= ch.mae * {S.dbl(1 - GATE_IMPROVEMENT)} AS promote FROM m ch JOIN m c ON ch.target = c.target "
    "WHERE ch.model_name LIKE 'persistence_24h_%' AND c.model_name LIKE 'persistence_1h_%'",
    dates=(),
)
def challenger_gate(spark, sf_dir):
    """Challenger must beat the champion's MAE by >= 2 % on the last 7 days."""
    as_of = F.lit(AS_OF).cast("date")
    p = predictions(spark, sf_dir)
    p = p.filter((F.to_date("ts") >= F.date_sub(as_of, 7)) & (F.to_date("ts") < as_of))
    m = A.regression_metrics(p, ["model_name", "target"])
    ch = m.filter(F.col("model_name").startswith("persistence_24h_")).select(
        "target", F.col("model_name").alias("champion_model"), F.col("mae").alias("champion_mae")
    )
    c = m.filter(F.col("model_name").startswith("persistence_1h_")).select(
        "target", F.col("model_name").alias("challenger_model"), F.col("mae").alias("challenger_mae")
    )
    return ch.join(c, "target").withColumn(
        "promote", F.col("challenger_mae") <= F.col("champion_mae") * F.lit(1 - GATE_IMPROVEMENT)
    )


MODEL_VERSION = "persistence-v1"


@query(
    "prediction_trace",
    "D7",
    f"WITH {CTE_PRED} SELECT model_name, target, city, ts, predicted, '{MODEL_VERSION}' AS model_version, "
    "sha256(city || '|' || strftime(ts, '%Y-%m-%d %H:%M:%S') || '|' || CAST(CAST(predicted AS DECIMAL(24,6)) AS VARCHAR)) "
    "AS feature_hash FROM pred",
    dates=(),
)
def prediction_trace(spark, sf_dir):
    """Every prediction with a model version and a hash of its inputs."""
    p = predictions(spark, sf_dir)
    h = F.sha2(
        F.concat_ws(
            "|",
            F.col("city"),
            F.date_format("ts", "yyyy-MM-dd HH:mm:ss"),
            F.col("predicted").cast("decimal(24,6)").cast("string"),
        ),
        256,
    )
    return p.select(
        "model_name", "target", "city", "ts", "predicted", F.lit(MODEL_VERSION).alias("model_version"), h.alias("feature_hash")
    )


def training_window(df, as_of, days: int = 120, ts: str = "ts"):
    """D3: rolling training window [as_of - days, as_of)."""
    t0 = F.lit(as_of).cast("timestamp")
    return df.filter((F.col(ts) >= F.timestamp_add("DAY", F.lit(-days), t0)) & (F.col(ts) < t0))


def clip_and_drop_sparse_days(df, ghi=(0.0, 1400.0), temp=(-10.0, 55.0), max_missing=0.30):
    """Clip to physical ranges, drop city-days with > 30 % missing fields."""
    from ..functions.decisions import clamp

    clipped = df.withColumn("ghi", clamp("ghi", *ghi)).withColumn("temp", clamp("temp", *temp))
    day = F.to_date("ts")
    miss = (F.col("ghi").isNull().cast("int") + F.col("temp").isNull().cast("int")) / 2.0
    w = Window.partitionBy("city", day)
    return clipped.withColumn("_m", F.avg(miss).over(w)).filter(F.col("_m") <= max_missing).drop("_m")

