"""Ingestion plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import HOURLY_VARIABLES
from ..operators import clean as C
from ..operators import timeseries as TS
from ..sources import fixtures as FX
from ..sources import ingest as I
from ..sources import payload as P
from ..sources import upsert as U
from . import sqltext as S
from .catalog import query
from .common import AS_OF_TS, dense_hourly

# Upsert scenario (F5): a first load saw events before the cut-off; the next
# poll re-delivers from three hours before the cut-off's hour, complete, and
# withholds temperature where an hour has a single reading.
UPSERT_CUTOFF = "2024-01-20 12:30:00"
REDELIVER_FROM = "2024-01-20 09:00:00"
PAYLOAD_VARS = {"temperature_2m": "temp", "shortwave_radiation": "ghi"}
CHUNK_DAYS = 90
# Only the oracle needs the category list spelled out; the Spark plan reads it.
DENSE_CITIES = ("click", "error", "purchase", "signup", "view")


@query(
    "payload_explode",
    "S1 S2 F4",
    f"WITH {S.CTE_DENSE_HOURLY} SELECT city AS city_name, ts AS timestamp, "
    + ", ".join(
        f"{PAYLOAD_VARS[x]} AS {x}" if x in PAYLOAD_VARS else f"CAST(NULL AS DOUBLE) AS {x}" for x in HOURLY_VARIABLES
    )
    + " FROM hourly",
    dates=(),
)
def payload_explode(spark, sf_dir):
    """F1 hourly means folded into per-city-day JSON payloads, then parsed back."""
    payloads = P.fold_payloads(dense_hourly(spark, sf_dir), PAYLOAD_VARS)
    return P.explode_payload(payloads, "city", "payload", strict=True)


def _upsert_inputs(spark, sf_dir):
    d = FX.dense(spark, sf_dir)
    cut = F.lit(UPSERT_CUTOFF).cast("timestamp")
    base = TS.hourly_means(d.filter(F.col("ts") < cut)).select(
        F.col("city").alias("city_name"),
        F.col("ts").alias("timestamp"),
        F.col("temp").alias("temperature_2m"),
        F.col("ghi").alias("shortwave_radiation"),
    )
    b = d.filter(F.col("ts") >= F.lit(REDELIVER_FROM).cast("timestamp"))
    batch = (
        b.groupBy(F.col("city").alias("city_name"), F.date_trunc("hour", "ts").alias("timestamp"))
        .agg(
            TS.exact_avg("temp").alias("_t"),
            F.count(F.lit(1)).alias("_n"),
            TS.exact_avg("ghi").alias("shortwave_radiation"),
        )
        .select(
            "city_name",
            "timestamp",
            F.when(F.col("_n") > 1, F.col("_t")).alias("temperature_2m"),
            "shortwave_radiation",
        )
    )
    return base, batch


@query(
    "upsert_merge",
    "S5 J4 F5",
    f"WITH {S.CTE_DENSE}, base AS (SELECT city AS city_name, date_trunc('hour', ts) AS timestamp, "
    f"{S.xavg('temp')} AS temperature_2m, {S.xavg('ghi')} AS shortwave_radiation FROM dense "
    f"WHERE ts < TIMESTAMP '{UPSERT_CUTOFF}' GROUP BY 1, 2), batch AS (SELECT city AS city_name, "
    f"date_trunc('hour', ts) AS timestamp, CASE WHEN count(*) > 1 THEN {S.xavg('temp')} END AS temperature_2m, "
    f"{S.xavg('ghi')} AS shortwave_radiation FROM dense WHERE ts >= TIMESTAMP '{REDELIVER_FROM}' GROUP BY 1, 2), "
    "u AS (SELECT *, 0 AS r FROM base UNION ALL SELECT *, 1 AS r FROM batch) "
    "SELECT city_name, timestamp, temperature_2m, shortwave_radiation, "
    "CASE WHEN r = 1 THEN 'batch' ELSE 'target' END AS origin FROM (SELECT *, row_number() OVER "
    "(PARTITION BY city_name, timestamp ORDER BY r DESC) AS rn FROM u) q WHERE rn = 1",
    dates=(),
)
def upsert_merge(spark, sf_dir):
    base, batch = _upsert_inputs(spark, sf_dir)
    return U.upsert(base, batch, ["city_name", "timestamp"])


_CONTRACT_SQL = (
    f"WITH {S.CTE_DENSE}, raw AS (SELECT city AS city_name, date_trunc('hour', ts) AS timestamp, ghi, temp FROM dense), "
    "r AS (SELECT count(*) FILTER (WHERE city_name IS NULL) AS null_city_name, "
    "count(*) FILTER (WHERE timestamp IS NULL) AS null_timestamp, "
    "count(*) FILTER (WHERE ghi < 0) AS negative_ghi, count(*) FILTER (WHERE ghi > 1400) AS ghi_above_1400, "
    "count(*) FILTER (WHERE temp < -10 OR temp > 55) AS temp_out_of_range, "
    "count(*) FILTER (WHERE month(timestamp) < 1 OR month(timestamp) > 12) AS month_out_of_range FROM raw), "
    "d AS (SELECT count(*) FILTER (WHERE c > 1) AS v FROM (SELECT city_name, timestamp, count(*) AS c FROM raw "
    "GROUP BY 1, 2) k) "
    "SELECT 'null_city_name' AS rule, CAST(null_city_name AS BIGINT) AS violations FROM r UNION ALL "
    "SELECT 'null_timestamp', CAST(null_timestamp AS BIGINT) FROM r UNION ALL "
    "SELECT 'negative_ghi', CAST(negative_ghi AS BIGINT) FROM r UNION ALL "
    "SELECT 'ghi_above_1400', CAST(ghi_above_1400 AS BIGINT) FROM r UNION ALL "
    "SELECT 'temp_out_of_range', CAST(temp_out_of_range AS BIGINT) FROM r UNION ALL "
    "SELECT 'month_out_of_range', CAST(month_out_of_range AS BIGINT) FROM r UNION ALL "
    "SELECT 'duplicate_key', CAST(v AS BIGINT) FROM d"
)


@query("contract_violations", "S6 B19 D4", _CONTRACT_SQL, dates=())
def contract_violations(spark, sf_dir):
    """Raw readings keyed at hour resolution: key, NOT NULL and range rules."""
    raw = FX.dense(spark, sf_dir).select(
        F.col("city").alias("city_name"), F.date_trunc("hour", "ts").alias("timestamp"), "ghi", "temp"
    )
    m = F.month("timestamp")
    checks = {
        "negative_ghi": F.col("ghi") < 0,
        "ghi_above_1400": F.col("ghi") > 1400,
        "temp_out_of_range": (F.col("temp") < -10) | (F.col("temp") > 55),
        "month_out_of_range": (m < 1) | (m > 12),
    }
    return U.contract_violations(raw, ["city_name", "timestamp"], ["city_name", "timestamp"], checks)


@query(
    "coverage",
    "S12 J6",
    f"WITH {S.CTE_SITES}, exp AS (SELECT DISTINCT city FROM sites), b AS (SELECT city, count(*) AS n FROM sites "
    f"WHERE ts BETWEEN TIMESTAMP '{AS_OF_TS}' - INTERVAL 3 HOUR AND TIMESTAMP '{AS_OF_TS}' + INTERVAL 1 HOUR "
    "GROUP BY city) SELECT exp.city, CAST(coalesce(n, 0) AS BIGINT) AS n_records, n IS NOT NULL AS delivered "
    "FROM exp LEFT JOIN b USING (city)",
    dates=(),
)
def coverage(spark, sf_dir):
    """Which stations delivered in the latest poll window (expected = all seen)."""
    sites = FX.sites(spark, sf_dir)
    return I.coverage(sites, I.incremental_slice(sites, AS_OF_TS), "city")


@query(
    "backfill_chunks",
    "S13",
    f"WITH {S.CTE_LONG}, b AS (SELECT min(CAST(ts AS DATE)) AS s, max(CAST(ts AS DATE)) AS e FROM long), "
    f"c AS (SELECT CAST(k AS BIGINT) AS chunk_id, CAST(s + CAST(k * {CHUNK_DAYS} AS INTEGER) AS DATE) AS chunk_start, "
    f"least(CAST(s + CAST(k * {CHUNK_DAYS} + {CHUNK_DAYS - 1} AS INTEGER) AS DATE), e) AS chunk_end FROM b, "
    f"range(0, CAST(floor((e - s) / {CHUNK_DAYS}) AS BIGINT) + 1) r(k)), "
    f"n AS (SELECT CAST(floor((CAST(ts AS DATE) - (SELECT s FROM b)) / {CHUNK_DAYS}) AS BIGINT) AS chunk_id, "
    "count(*) AS cnt FROM long GROUP BY 1) SELECT c.chunk_id, chunk_start, chunk_end, "
    "CAST(coalesce(cnt, 0) AS BIGINT) AS n_rows FROM c LEFT JOIN n USING (chunk_id)",
    dates=("chunk_start", "chunk_end"),
)
def backfill_chunks(spark, sf_dir):
    return I.backfill_chunks(FX.long_history(spark, sf_dir), CHUNK_DAYS)


@query(
    "incremental_slice",
    "S14",
    f"WITH {S.CTE_DENSE} SELECT city, ts, ghi, temp FROM dense "
    f"WHERE ts BETWEEN TIMESTAMP '{AS_OF_TS}' - INTERVAL 3 HOUR AND TIMESTAMP '{AS_OF_TS}' + INTERVAL 1 HOUR",
    dates=(),
)
def incremental_slice(spark, sf_dir):
    return I.incremental_slice(FX.dense(spark, sf_dir), AS_OF_TS)


@query(
    "stable_recent_split",
    "B20 B21",
    f"WITH {S.CTE_DENSE_HOURLY} SELECT city, ts, ghi, temp, CASE WHEN ts <= TIMESTAMP '{AS_OF_TS}' - INTERVAL 2 DAY "
    "THEN 'stable' ELSE 'recent' END AS slice FROM hourly",
    dates=(),
)
def stable_recent_split(spark, sf_dir):
    return I.stable_recent_split(dense_hourly(spark, sf_dir), AS_OF_TS, 2)


@query(
    "model_matrix",
    "B26 B27",
    f"WITH {S.CTE_DENSE}, {S.hourly_cte('dense', 'sh')}, bounds AS (SELECT city, min(ts) AS t0, max(ts) AS t1 FROM sh "
    "GROUP BY city), spine AS (SELECT b.city, g.ts FROM bounds b, LATERAL (SELECT unnest(generate_series(b.t0, b.t1, "
    "INTERVAL 1 HOUR)) AS ts) g), grid AS (SELECT s.city, s.ts, h.ghi, h.temp FROM spine s LEFT JOIN sh h "
    "ON s.city = h.city AND s.ts = h.ts) SELECT city, ts, CAST(epoch(ts) AS BIGINT) AS epoch_seconds, "
    + ", ".join(f"CAST(CASE WHEN city = '{c}' THEN 1 ELSE 0 END AS INTEGER) AS city_{c}" for c in DENSE_CITIES)
    + f", coalesce(ghi, {S.dbl(0)}) AS ghi, coalesce(temp, {S.dbl(0)}) AS temp FROM grid",
    dates=(),
)
def model_matrix(spark, sf_dir):
    grid = TS.hourly_grid(FX.dense(spark, sf_dir))
    cats = C.categories_of(FX.dense(spark, sf_dir).select("city"))
    return C.model_matrix(grid, cats, ["ghi", "temp"])


_F1_MAPPING = {
    "city": "event_type",
    "ts": "CAST(ts AS TIMESTAMP)",
    "ghi": "round(value * 8, 4)",
    "temp": "CAST(100 + 3 * CAST(get_json_object(props, '$.k') AS INT) AS DOUBLE) / 10",
}


@query("weather_source", "S3 S4 O1 O2 B1", f"{S.SQL_DENSE_WRAPPED}", dates=())
def weather_source(spark, sf_dir):
    """S4 precedence: a curated table if registered, else the events file,
    each with its own column mapping; S3 projected scan, non-empty guard."""
    from ..sources.tables import Source, first_existing, require_non_empty

    candidates = [
        Source("weather_observations", {"city": "city_name", "ts": "timestamp", "ghi": "shortwave_radiation",
                                        "temp": "temperature_2m"}),
        Source(f"{sf_dir}/events.parquet", _F1_MAPPING, is_path=True),
    ]
    return require_non_empty(first_existing(spark, candidates), "weather source")
