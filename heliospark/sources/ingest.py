"""Ingestion planning operators.

All time windows take an injected ``as_of``; nothing reads the wall clock.
Range predicates on the event time are pushed to the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def incremental_slice(df: DataFrame, as_of, past_hours: int = 3, ahead_hours: int = 1, ts: str = "ts") -> DataFrame:
    """Rows in [as_of - past_hours, as_of + ahead_hours]."""
    t0 = F.lit(as_of).cast("timestamp")
    lo = F.timestamp_add("HOUR", F.lit(-past_hours), t0)
    hi = F.timestamp_add("HOUR", F.lit(ahead_hours), t0)
    return df.filter(F.col(ts).between(lo, hi))


def historic_window(as_of, lookback_days: int = 365, lag_days: int = 2) -> tuple:
    """S14 default historic slice: (as_of - lookback, as_of - lag) as dates."""
    d = F.lit(as_of).cast("date")
    return F.date_sub(d, lookback_days), F.date_sub(d, lag_days)


def backfill_chunks(df: DataFrame, chunk_days: int = 90, ts: str = "ts", start=None, end=None) -> DataFrame:
    """Gapless inclusive <= ``chunk_days`` chunks over [start, end] (from
    the data when not given), with the number of rows falling in each."""
    # One pass over the rows: a count for each day, from which all else is made.
    daily = df.groupBy(F.to_date(F.col(ts)).alias("_day")).agg(F.count(F.lit(1)).alias("_rows"))
    bounds = daily.agg(F.min("_day").alias("_s"), F.max("_day").alias("_e"))
    if start is not None:
        bounds = bounds.withColumn("_s", F.lit(start).cast("date"))
    if end is not None:
        bounds = bounds.withColumn("_e", F.lit(end).cast("date"))
    chunks = bounds.select(
        "_s",
        "_e",
        F.posexplode(F.sequence(F.col("_s"), F.col("_e"), F.expr(f"INTERVAL {chunk_days} DAYS"))).alias(
            "chunk_id", "chunk_start"
        ),
    ).select(
        F.col("chunk_id").cast("bigint").alias("chunk_id"),
        "chunk_start",
        F.least(F.date_add(F.col("chunk_start"), chunk_days - 1), F.col("_e")).alias("chunk_end"),
        "_s",
    )
    # The range start is a one-value aggregate attached as a scalar subquery.
    start_val = F.lit(start).cast("date") if start is not None else daily.agg(F.min("_day")).scalar()
    counts = daily.groupBy(F.floor(F.datediff("_day", start_val) / chunk_days).cast("bigint").alias("chunk_id")).agg(F.sum("_rows").alias("count"))
    return chunks.drop("_s").join(counts, "chunk_id", "left").select(
        "chunk_id", "chunk_start", "chunk_end", F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("n_rows")
    )


def coverage(expected: DataFrame, batch: DataFrame, key: str = "city") -> DataFrame:
    """Per expected key, records delivered in ``batch`` and a flag."""
    counts = batch.groupBy(key).agg(F.count(F.lit(1)).alias("n_records"))
    return expected.select(key).distinct().join(counts, key, "left").select(
        key,
        F.coalesce(F.col("n_records"), F.lit(0)).cast("bigint").alias("n_records"),
        F.col("n_records").isNotNull().alias("delivered"),
    )


def missing_keys(expected: DataFrame, batch: DataFrame, key: str = "city") -> DataFrame:
    """Expected keys with no record in the batch."""
    return expected.select(key).distinct().join(batch.select(key), key, "left_anti")


def stable_recent_split(df: DataFrame, as_of, lag_days: int = 2, ts: str = "ts") -> DataFrame:
    """``stable`` when ts <= as_of - lag_days, else ``recent``."""
    cutoff = F.timestamp_add("DAY", F.lit(-lag_days), F.lit(as_of).cast("timestamp"))
    return df.withColumn("slice", F.when(F.col(ts) <= cutoff, F.lit("stable")).otherwise(F.lit("recent")))


def guard_training_slice(df: DataFrame, allow_recent: bool = False) -> DataFrame:
    """Refuse to train on rows marked ``recent`` unless overridden."""
    if allow_recent:
        return df
    # A filter, so that no later projection or count prunes the check.
    refusal = F.raise_error(F.lit("refusing to train on the recent slice")).cast("boolean")
    return df.filter(F.when(F.col("slice") == "recent", refusal).otherwise(True))


def slice_city_range(df: DataFrame, city: str, start, end, ts: str = "ts", key: str = "city") -> DataFrame:
    """One city between two instants (inclusive); an empty slice is an
    error (checked with a one-row probe). The predicates reach the scan."""
    out = df.filter((F.col(key) == city) & F.col(ts).between(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")))
    if out.isEmpty():
        raise ValueError(f"no rows for {city} between {start} and {end}")
    return out


def assert_any_delivered(report: DataFrame) -> DataFrame:
    """A poll in which no expected key delivered anything is an error
    (one-row probe on the coverage report)."""
    if report.filter(F.col("delivered")).isEmpty():
        raise RuntimeError("no expected city delivered any record")
    return report


def ingest_summary(report: DataFrame) -> DataFrame:
    """One row: expected keys, those that delivered, those that failed, and
    whether the poll was partial. An all-failed poll is an error."""
    done = assert_any_delivered(report)
    return done.agg(
        F.count(F.lit(1)).cast("bigint").alias("total"),
        F.count_if("delivered").cast("bigint").alias("successes"),
        F.count_if(~F.col("delivered")).cast("bigint").alias("failures"),
        (F.count_if(~F.col("delivered")) > 0).alias("partial"),
    )
