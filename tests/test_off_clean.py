"""Inputs off the clean path: NaN, NULL sequences, odd times, guards."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from heliospark.operators import clean as C
from heliospark.operators import timeseries as TS
from heliospark.sources import ingest as I
from heliospark.sources.payload import parse_wall_time
from heliospark.sources.upsert import upsert
from heliospark.streaming.jobs import settle

T0 = dt.datetime(2024, 1, 1, 5)


def test_nan_is_missing_in_means(spark):
    df = spark.createDataFrame([("a", T0, float("nan"), None), ("a", T0, 5.0, float("nan"))], "city string, ts timestamp, ghi double, temp double")
    row = TS.hourly_means(df).first()
    assert row["ghi"] == 5.0 and row["temp"] is None


def test_upsert_with_null_and_large_sequences(spark):
    schema = "k int, v double, seq long"
    target = spark.createDataFrame([(1, 1.0, 0), (2, 2.0, 0)], schema)
    batch = spark.createDataFrame([(1, 10.0, None), (3, 30.0, None), (2, 20.0, 1 << 62), (2, None, (1 << 62) + 1), (4, 4.0, -9), (4, 5.0, None)], schema)
    out = {r.k: (r.v, r.origin) for r in upsert(target, batch, ["k"], "seq").collect()}
    assert out == {1: (10.0, "batch"), 2: (None, "batch"), 3: (30.0, "batch"), 4: (4.0, "batch")}


def test_settle_ranks_batch_before_sequence(spark):
    rows = [(1, 1.0, 0, 1 << 40), (1, 2.0, 1, 3), (2, 5.0, 0, None), (2, 6.0, 0, -4)]
    out = {r.k: r.v for r in settle(spark.createDataFrame(rows, "k int, v double, _batch long, seq long"), ["k"], "seq").collect()}
    assert out == {1: 2.0, 2: 6.0}


def test_guards_survive_pruning(spark):
    bad = spark.createDataFrame([("2024-01-01", 1.0), ("never", 2.0)], "ts string, g double")
    missing = spark.createDataFrame([("2024-01-01", 1.0), (None, 2.0)], "ts string, g double")
    recent = spark.createDataFrame([("recent", 1.0)], "slice string, g double")
    for df in (C.parse_utc_strict(bad), C.parse_utc_strict(missing), I.guard_training_slice(recent)):
        with pytest.raises(Exception):
            df.count()
        with pytest.raises(Exception):
            df.select("g").collect()
    assert I.guard_training_slice(recent, allow_recent=True).count() == 1


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("2025-06-01T05", dt.datetime(2025, 6, 1, 5)),
        ("20250601T05:00", dt.datetime(2025, 6, 1, 5)),
        ("20250601T050607.25+0530", dt.datetime(2025, 6, 1, 5, 6, 7, 250000)),
        ("2025-06-01 05:06Z", dt.datetime(2025, 6, 1, 5, 6)),
        ("2025-06-01", dt.datetime(2025, 6, 1)),
        ("2025-0601", None),
        ("2025-13-01T00:00", None),
        ("soon", None),
        (None, None),
    ],
)
def test_iso_times(spark, text, want):
    got = spark.createDataFrame([(text,)], "t string").select(F.date_format(parse_wall_time(F.col("t")), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("x")).first().x
    assert got == (want and want.strftime("%Y-%m-%d %H:%M:%S.%f"))
