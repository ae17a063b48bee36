"""Global-order helpers versus brute force on small data with many partitions."""

from __future__ import annotations

import datetime as dt
import random

import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from heliospark.operators import global_order as G

T0 = dt.datetime(2024, 1, 1)


def _data(spark, n=400, seed=3):
    rnd = random.Random(seed)
    rows = [(i, rnd.randint(0, 50), None if rnd.random() < 0.35 else rnd.uniform(0, 100)) for i in range(n)]
    rows[0] = (0, rows[0][1], None)
    rows[-1] = (n - 1, rows[-1][1], None)
    return spark.createDataFrame(rows, "id long, k int, v double")


def test_global_index_is_dense_and_ordered(spark):
    df = _data(spark)
    got = G.with_global_index(df, ["k", "id"], "g", num_partitions=13).select("id", "g").toPandas()
    want = df.toPandas().sort_values(["k", "id"]).reset_index(drop=True)
    want["g"] = range(len(want))
    m = got.merge(want[["id", "g"]], on="id", suffixes=("", "_w"))
    assert (m["g"] == m["g_w"]).all() and len(m) == len(want)


def test_interpolate_both_matches_pandas(spark):
    df = _data(spark)
    idx = G.with_global_index(df, ["id"], "g", num_partitions=11)
    got = G.interpolate_both(idx, ["v"], "g").select("id", "v").toPandas().sort_values("id")
    pdf = df.toPandas().sort_values("id").reset_index(drop=True)
    want = pdf["v"].interpolate(limit_direction="both").ffill().bfill()
    assert (abs(got["v"].to_numpy() - want.to_numpy()) < 1e-9).all()


def test_halo_lags_match_brute_force(spark):
    df = spark.range(200).select(F.col("id"), (F.col("id") * 1.5).alias("v"))
    idx = G.with_global_index(df, ["id"], "g", num_partitions=37)  # many partitions shorter than the lag
    halo = G.with_halo(idx, back=24, ahead=1, idx="g")
    w = Window.partitionBy("_pid").orderBy("g")
    out = (
        halo.select("_own", "id", F.lag("v", 24).over(w).alias("l24"), F.lead("v", 1).over(w).alias("n1"))
        .filter("_own")
        .toPandas()
        .sort_values("id")
    )
    pdf = pd.DataFrame({"id": range(200), "v": [i * 1.5 for i in range(200)]})
    assert out["l24"].fillna(-1).tolist() == pdf["v"].shift(24).fillna(-1).tolist()
    assert out["n1"].fillna(-1).tolist() == pdf["v"].shift(-1).fillna(-1).tolist()


def test_edges_reach_across_short_partitions(spark):
    df = spark.range(200).select(F.col("id"), (F.col("id") * 1.5).alias("v"))
    idx = G.with_global_index(df, ["id"], "g", num_partitions=37)  # many partitions shorter than the lag
    edged = G.with_edges(idx, "g", ["v"], back=24, ahead=2)
    out = edged.select("id", *[G.edge_lag("v", k, "g").alias(f"k{k + 5}") for k in (-2, -1, 1, 3, 24)]).toPandas().sort_values("id")
    v = pd.DataFrame({"v": [i * 1.5 for i in range(200)]})["v"]
    for k in (-2, -1, 1, 3, 24):
        assert out[f"k{k + 5}"].fillna(-1).tolist() == v.shift(k).fillna(-1).tolist()
    assert edged.select(F.max(F.size("_before"))).first()[0] == 24
    none = G.with_edges(idx.limit(0), "g", ["v"], back=24, ahead=1)
    assert none.count() == 0


def test_global_sequences_cross_cities(spark):
    from heliospark.operators import timeseries as TS

    rows = [(f"c{i % 3}", T0 + dt.timedelta(hours=i // 3), float(i), None if i % 7 == 0 else i / 2) for i in range(150)]
    df = spark.createDataFrame(rows, "city string, ts timestamp, ghi double, temp double").repartition(20)
    got = sorted((r["ts"], r["city"], r["sequence"], r["label"]) for r in TS.sequences_global(df, ["ghi", "temp"], "ghi", 24).collect())
    want = [(rows[i][1], rows[i][0], [[rows[k][2], rows[k][3]] for k in range(i - 24, i)], rows[i][2]) for i in range(24, 150)]
    assert got == want
    assert TS.sequences_global(df.limit(20), ["ghi", "temp"], "ghi", 24).count() == 0


def test_timestamps_shared_by_partitions_are_consolidated(spark):
    """One instant holds most rows, so range partitions share it."""
    from heliospark.operators import station as ST

    rnd = random.Random(5)
    rows = [(T0 if i % 3 else T0 + dt.timedelta(minutes=i), rnd.choice([None, float(i)]), f"f{i % 4}", i, float(i % 50)) for i in range(900)]
    st = spark.createDataFrame(rows, "timestamp timestamp, temperature double, source_file string, _row long, ghi double")
    spread = ST.interpolate_station(st)
    assert spread.where(F.col("timestamp") == F.lit(T0)).select("_pid").distinct().count() > 1
    key = lambda r: r["timestamp"]
    got = sorted((r.asDict() for r in ST.consolidate_in_place(spread).drop("_pid").collect()), key=key)
    want = sorted((r.asDict() for r in ST.consolidate(spread.drop("_pid")).collect()), key=key)
    assert got == want and len(got) == 1 + 299
    plan = ST.station_features(st)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan  # one range sort, below the stored rows


def test_series_by_file_and_over_files_differ_at_the_edges(spark):
    from heliospark.operators import station as ST

    rows = [(T0 + dt.timedelta(hours=i // 2), 20.0 + i, f"f{i % 2}", i, float(i)) for i in range(80)]
    st = spark.createDataFrame(rows, "timestamp timestamp, temperature double, source_file string, _row long, ghi double")
    own = ST.station_features(st, global_order=False)
    assert own.count() == 2 * 39 and ST.station_features(st).count() == 39
    first = own.where("source_file = 'f1'").orderBy("timestamp").first()
    assert first["ghi"] == 1.0 and first["ghi_lag_1"] == 0.0 and first["target_ghi_next_1h"] == 3.0
