"""Weather-shaped views over the driver's parquet tables.

The driver ships no weather table, so each view below re-reads a given table
and derives ``city, ts, ghi, temp`` from it (see FIXTURES.md). Every view
keeps all rows of its source table; the work grows with the table.

* ``dense``  (F1): events, city = event_type  -> a few very busy "cities".
* ``sites``  (F2): events, city = 'site_' || user_id -> many sparse stations
  whose reports leave short and long gaps (imputation input).
* ``long``   (F3): lineitem, city = returnflag, seven years of hours.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _k(props: str = "props"):
    return F.get_json_object(F.col(props), "$.k").cast("int")


def _event_measures():
    return [
        F.col("ts").cast("timestamp").alias("ts"),
        F.round(F.col("value") * F.lit(8), 4).alias("ghi"),
        ((F.lit(100) + F.lit(3) * _k()).cast("double") / F.lit(10)).alias("temp"),
    ]


def dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """one reading per event, city = event type."""
    ev = table(spark, sf_dir, "events")
    return ev.select(F.col("event_type").alias("city"), *_event_measures())


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """one station per user id; sparse, irregular reporting."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.concat(F.lit("site_"), F.col("user_id").cast("string")).alias("city"), *_event_measures()
    )


def long_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """multi-year hours from lineitem (ship date + partkey-derived hour)."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_returnflag").alias("city"),
        F.timestamp_add("HOUR", F.pmod(F.col("l_partkey"), F.lit(24)), F.col("l_shipdate").cast("timestamp")).alias(
            "ts"
        ),
        (F.col("l_extendedprice") / F.lit(100)).alias("ghi"),
        F.col("l_quantity").alias("temp"),
    )


def events_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the typed timestamp; used by payload / station / streaming views."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        "event_id", "user_id", "event_type", *_event_measures(), _k().alias("k"), F.col("value")
    )


# DuckDB text of the same views (used by the oracle SQL).
SQL_DENSE = (
    "SELECT event_type AS city, ts, round(value * 8, 4) AS ghi, "
    "CAST(100 + 3 * CAST(json_extract_string(props, '$.k') AS INTEGER) AS DOUBLE) / 10 AS temp FROM events"
)
SQL_SITES = (
    "SELECT 'site_' || CAST(user_id AS VARCHAR) AS city, ts, round(value * 8, 4) AS ghi, "
    "CAST(100 + 3 * CAST(json_extract_string(props, '$.k') AS INTEGER) AS DOUBLE) / 10 AS temp FROM events"
)
SQL_LONG = (
    "SELECT l_returnflag AS city, l_shipdate + to_hours(CAST(l_partkey % 24 AS BIGINT)) AS ts, "
    "l_extendedprice / 100 AS ghi, l_quantity AS temp FROM lineitem"
)


def station_files(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """the events table written out as five per-type "station files",
    each with its own raw header names and text formats (as a CSV read
    would return them). Together they hold every event; one file has no GHI
    column and is unusable, one has unparseable GHI text."""
    ev = events_raw(spark, sf_dir)
    t = F.date_format(F.col("ts"), "yyyy-MM-dd HH:mm:ss")
    s = lambda c: c.cast("string")
    row = F.col("event_id").alias("_row")

    def of(kind):
        return ev.filter(F.col("event_type") == kind)

    return {
        "station_click.csv": of("click").select(
            t.alias("TIMESTAMP"),
            s(F.col("ghi")).alias("GHI_corr_Avg"),
            s(F.col("temp")).alias("Tair_Avg"),
            s(F.col("k")).alias("RH_Avg"),
            s(F.col("value") / 10).alias("WS"),
            row,
        ),
        "station_error.csv": of("error").select(
            F.date_format("ts", "yyyy-MM-dd").alias("Date"),
            F.date_format("ts", "HH:mm:ss").alias("Time"),
            s(F.col("ghi")).alias("GHI"),
            s(F.col("temp")).alias("Tamb"),
            s(F.lit(900) + F.col("k")).alias("BP"),
            row,
        ),
        "station_purchase.csv": of("purchase").select(
            t.alias("TS"),
            s(F.col("ghi")).alias("ghi_corr_avg"),
            s(F.col("temp")).alias("Temp"),
            s(F.col("value") / 10).alias("WindSpeed"),
            s(F.col("value") / 5).alias("WSgust"),
            row,
        ),
        "station_signup.csv": of("signup").select(
            t.alias("Timestamp"),
            F.when(F.col("k") == 0, F.lit("n/a")).otherwise(s(F.col("ghi"))).alias("GHI"),
            s(F.col("k")).alias("RH"),
            s(F.col("k") * F.lit(3.6)).alias("WD"),
            row,
        ),
        "station_view.csv": of("view").select(
            t.alias("Timestamp"), s(F.col("temp")).alias("Tair_Avg"), s(F.col("k")).alias("RH"), row
        ),
    }
