"""Shared pieces of the registered query plans."""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import ImputeConfig
from ..operators import timeseries as TS
from ..sources import fixtures as FX
from ..sources.grid_store import bucketed_table, input_state

# Injected "now" for every wall-clock-dependent operator (F1 spans 2024-01).
AS_OF = "2024-01-28"
AS_OF_TS = "2024-01-28 12:00:00"


def to_output(df: DataFrame) -> DataFrame:
    """Emit timestamps and dates as TIMESTAMP_NTZ (what the parquet tables hold)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.TimestampType, T.DateType)):
            cols.append(F.col(f.name).cast("timestamp_ntz").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def dense_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 reduced to hourly means (T1 step 1)."""
    return TS.hourly_means(FX.dense(spark, sf_dir))


def long_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F3 reduced to hourly means."""
    return TS.hourly_means(FX.long_history(spark, sf_dir))


def sites_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F2 on its per-site hourly grid, in tasks of bounded rows."""
    src = FX.sites(spark, sf_dir)
    return TS.hourly_grid(src, tasks=TS.tasks_for(spark, TS.grid_rows(src)))


def stored_grid(spark: SparkSession, sf_dir: str, view=FX.sites, name: str = "sites_grid") -> DataFrame:
    """The imputed hourly grid of a view (T1, T6), bucketed and sorted by (city, ts)."""
    src = view(spark, sf_dir)
    tasks = cache(lambda: TS.tasks_for(spark, TS.grid_rows(src)))
    return bucketed_table(spark, name, input_state(src), lambda: TS.impute(TS.hourly_grid(src, tasks=tasks()), ImputeConfig()), buckets=tasks)
