"""Folders and files of the feature sink, whatever the number of cities."""

from __future__ import annotations

import datetime as dt
import os
import tempfile

from heliospark.operators import timeseries as TS
from heliospark.sources import tables as TB
from pyspark.sql import functions as F
from test_task_sizes import T0, _sparse


def test_many_cities_share_feature_folders(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="heliospark-test-groups-"), "f")
    df = TS.hourly_grid(_sparse(spark, cities=60, span=20)).drop("i")
    df = df.withColumn("slice", F.when(F.col("ts") < F.lit(T0 + dt.timedelta(hours=10)), "stable").otherwise("recent"))
    TB.write_features(df, path, most_cities=50)
    back = TB.read_features(spark, path)
    assert sorted(back.columns) == sorted(df.columns)
    assert sorted(map(repr, map(tuple, back.select(*df.columns).collect()))) == sorted(map(repr, map(tuple, df.collect())))
    files = [f for _, _, names in os.walk(path) for f in names if f.endswith(".parquet")]
    assert len(files) <= 2 * int(spark.conf.get("spark.sql.shuffle.partitions")) < 60
