"""Streaming plans (ST1-ST4): run the stream to completion (available-now
trigger) and return the settled result table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import CoolingConfig
from ..sources import fixtures as FX
from ..streaming import jobs as P
from ..session import shared_path
from . import sqltext as S
from .catalog import query
from .common import dense_hourly
from .q_daily import _SQL_MODE
from .q_ingest import REDELIVER_FROM, UPSERT_CUTOFF, _upsert_inputs

CFG = CoolingConfig()


def _events_stream(spark, sf_dir):
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    ev = P.file_stream(spark, sf_dir, schema, "parquet", glob="events.parquet")
    return ev.select(
        F.col("event_type").alias("city"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.round(F.col("value") * F.lit(8), 4).alias("ghi"),
        ((F.lit(100) + F.lit(3) * F.get_json_object("props", "$.k").cast("int")).cast("double") / F.lit(10)).alias(
            "temp"
        ),
    )


@query(
    "stream_hourly_mean",
    "ST1 ST3",
    f"WITH {S.CTE_DENSE_HOURLY} SELECT city, ts, ghi, temp FROM hourly",
    dates=(),
)
def stream_hourly_mean(spark, sf_dir):
    """Events as a file stream -> tumbling hour mean per city."""
    return P.hourly_means_stream(_events_stream(spark, sf_dir), name="stream-hourly")


@query(
    "stream_upsert",
    "ST2 S5",
    f"WITH {S.CTE_DENSE}, base AS (SELECT city AS city_name, date_trunc('hour', ts) AS timestamp, "
    f"{S.xavg('temp')} AS temperature_2m, {S.xavg('ghi')} AS shortwave_radiation FROM dense "
    f"WHERE ts < TIMESTAMP '{UPSERT_CUTOFF}' GROUP BY 1, 2), batch AS (SELECT city AS city_name, "
    f"date_trunc('hour', ts) AS timestamp, CASE WHEN count(*) > 1 THEN {S.xavg('temp')} END AS temperature_2m, "
    f"{S.xavg('ghi')} AS shortwave_radiation FROM dense WHERE ts >= TIMESTAMP '{REDELIVER_FROM}' GROUP BY 1, 2), "
    "u AS (SELECT *, 0 AS r FROM base UNION ALL SELECT *, 1 AS r FROM batch) "
    "SELECT city_name, timestamp, temperature_2m, shortwave_radiation FROM (SELECT *, row_number() OVER "
    "(PARTITION BY city_name, timestamp ORDER BY r DESC) AS rn FROM u) q WHERE rn = 1",
    dates=(),
)
def stream_upsert(spark, sf_dir):
    """Two deliveries (first load, re-delivery) land as files and are merged;
    the producer's delivery sequence decides within a micro-batch."""
    base, batch = _upsert_inputs(spark, sf_dir)
    landing = shared_path(spark, "landing-upsert")
    base.withColumn("_delivery", F.lit(0)).write.parquet(landing + "/d0")
    batch.withColumn("_delivery", F.lit(1)).write.parquet(landing + "/d1")
    schema = spark.read.parquet(landing + "/d0").schema
    stream = (
        spark.readStream.schema(schema)
        .option("recursiveFileLookup", "true")
        .parquet(landing)
    )
    return P.upsert_stream(stream, ["city_name", "timestamp"], "_delivery", "stream-upsert")


@query(
    "stream_decision",
    "ST4 B11 B12 B14",
    f"WITH {S.CTE_DENSE_HOURLY} SELECT city, ts, ghi, temp, {_SQL_MODE} AS mode, "
    f"coalesce(temp >= {S.dbl(CFG.cooling_temp_threshold_c)}, false) AS cooling_needed, "
    f"CASE WHEN ({_SQL_MODE}) = 'NO_COOLING_NEEDED' THEN 'NO COOLING NEEDED' END AS no_cooling_needed_banner, "
    f"round({S.dbl(CFG.dc_kw)} * (greatest({S.dbl(0)}, ghi) / {S.dbl(1000)}), 4) AS solar_generation_kw, "
    f"{S.dbl(round(CFG.electrical_load_kw, 4))} AS electrical_load_kw, "
    f"{S.dbl(CFG.cooling_capacity_kw_thermal)} AS cooling_capacity_kw_thermal, {S.dbl(CFG.cop_ideal)} AS cop_ideal "
    "FROM hourly",
    dates=(),
)
def stream_decision(spark, sf_dir):
    """Hourly rows landed as files -> stateless decision rows (file sink)."""
    landing = shared_path(spark, "landing-hourly")
    dense_hourly(spark, sf_dir).write.parquet(landing)
    schema = spark.read.parquet(landing).schema
    stream = spark.readStream.schema(schema).parquet(landing)
    return P.decision_stream(stream, CFG, "stream-decision")
