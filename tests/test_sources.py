"""Sources, sinks and guards on small hand-made inputs."""

from __future__ import annotations

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from heliospark.operators import clean as C
from heliospark.plans.ghi_analysis import ghi_analysis
from heliospark.plans.q_quality import clip_and_drop_sparse_days, training_window
from heliospark.sources import station as SS
from heliospark.sources import tables as TB

T0 = dt.datetime(2024, 1, 1)


def test_canonical_names():
    got = {h: SS.canonical_name(h) for h in ["GHI_corr_Avg", " Tair_Avg ", "RH", "BP_CS100_Avg", "WSgust", "TS", "WS_WVC_1", "Foo Bar!"]}
    assert got == {
        "GHI_corr_Avg": "ghi", " Tair_Avg ": "temperature", "RH": "humidity", "BP_CS100_Avg": "pressure",
        "WSgust": "wind_gust", "TS": "timestamp", "WS_WVC_1": "wind_speed", "Foo Bar!": "foo_bar",
    }


def _csv(dirpath, name, text):
    p = os.path.join(dirpath, name)
    with open(p, "w") as f:
        f.write(text)
    return p


def test_station_csv_files_and_unusable(spark):
    d = tempfile.mkdtemp(prefix="heliospark-test-station-")
    a = _csv(d, "a.csv", "TIMESTAMP,GHI_corr_Avg,Tair_Avg\n2024-01-01 00:00:00,10,20\n2024-01-01 01:00:00,bad,21\n"
             "2024-01-01 02:00:00,30,22\n")
    b = _csv(d, "b.csv", "Date,Time,GHI,RH\n2024-01-01,00:30:00,15,50\n2024-01-01,01:30:00,25,55\n")
    c = _csv(d, "c.csv", "Timestamp,Tamb\n2024-01-01 00:00:00,5\n")  # no GHI: unusable
    out = SS.read_station_files(spark, [a, b, c])
    rows = out.orderBy("timestamp").collect()
    assert [r["ghi"] for r in rows] == [10.0, 15.0, 25.0, 30.0]  # 'bad' GHI row dropped
    assert set(out.columns) >= {"temperature", "humidity", "source_file"}
    assert {r["source_file"] for r in rows} == {"a.csv", "b.csv"}


def test_source_precedence_and_empty(spark):
    df = spark.createDataFrame([("x", T0, 1.0, 2.0)], "city_name string, timestamp timestamp, sw double, t double")
    df.createOrReplaceTempView("curated_weather_test")
    cands = [
        TB.Source("missing_table_xyz", {"city": "a", "ts": "b", "ghi": "c", "temp": "d"}),
        TB.Source("curated_weather_test", {"city": "city_name", "ts": "timestamp", "ghi": "sw", "temp": "t"}),
    ]
    got = TB.first_existing(spark, cands).collect()
    assert got[0]["ghi"] == 1.0
    with pytest.raises(ValueError):
        TB.require_non_empty(df.filter(F.lit(False)))
    with pytest.raises(ValueError):
        TB.first_existing(spark, cands[:1])


def test_required_columns_guard(spark):
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(ValueError, match="Missing required columns"):
        C.require_columns(df, ["a", "b"])


def test_strict_timestamp_parse(spark):
    ok = spark.createDataFrame([("2024-01-01T03:00",), ("2024-01-02 04:00:00",)], "ts string")
    assert C.parse_utc_strict(ok).filter(F.col("ts").isNull()).count() == 0
    bad = spark.createDataFrame([("2024-01-01T03:00",), ("NOT-A-DATE",)], "ts string")
    with pytest.raises(Exception):
        C.parse_utc_strict(bad).collect()


def test_registry_append_and_read(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="heliospark-test-reg-"), "registry")
    m = spark.createDataFrame([("m1", "GHI", 1.0, 2.0)], "model_name string, target string, mae double, rmse double")
    TB.append_registry(m, path, "run-1")
    TB.append_registry(m, path, "run-2")
    assert TB.read_registry(spark, path).select("run_id").distinct().count() == 2


def test_feature_sink_and_reader_reject_empty(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="heliospark-test-feat-"), "f")
    df = spark.createDataFrame([("a", T0, 1.0, "stable")], "city string, ts timestamp, ghi double, slice string")
    TB.write_features(df, path)
    assert TB.read_features(spark, path).count() == 1
    empty = os.path.join(tempfile.mkdtemp(prefix="heliospark-test-feat-"), "e")
    TB.write_features(df.filter(F.lit(False)), empty)
    with pytest.raises(Exception):
        TB.read_features(spark, empty)


def test_model_matrix_and_target_selection(spark):
    df = spark.createDataFrame([("b", T0, None, 1.0), ("a", T0, 2.0, None)], "city string, ts timestamp, ghi double, target_ghi_next_1h double")
    mm = C.model_matrix(df, ["b", "a"], ["ghi"]).orderBy("city").collect()
    assert [(r["city_a"], r["city_b"], r["ghi"]) for r in mm] == [(1, 0, 2.0), (0, 1, 0.0)]
    feats, target = C.select_for_target(df, "ghi", {"ghi": "target_ghi_next_1h"})
    assert target == "target_ghi_next_1h" and feats == ["ghi"]


def test_ghi_analysis_parts(spark):
    rows = [("c", T0 + dt.timedelta(hours=h), float(h), 20.0) for h in range(24 * 8)]
    df = spark.createDataFrame(rows, "city string, ts timestamp, ghi double, temp double")
    parts = ghi_analysis(df, "c", "2024-01-08", "2024-01-08")
    assert set(parts) == {"statistics", "weekly_trend", "city_comparison", "seasonal"}
    assert parts["weekly_trend"].count() == 7 and parts["statistics"].count() == 1


def test_training_window_and_sparse_days(spark):
    rows = [("c", T0 + dt.timedelta(days=d), 2000.0 if d == 0 else 10.0, None if d == 1 else 20.0) for d in range(200)]
    df = spark.createDataFrame(rows, "city string, ts timestamp, ghi double, temp double")
    w = training_window(df, "2024-07-01", 120)
    assert w.agg(F.min("ts")).first()[0] >= dt.datetime(2024, 3, 3)
    c = clip_and_drop_sparse_days(df)
    assert c.filter(F.col("ghi") > 1400).count() == 0
    assert c.count() == 199  # the day with a missing temperature (50 % missing) is dropped


def test_city_range_slice_and_empty(spark):
    from heliospark.sources import ingest as I

    df = spark.createDataFrame([("a", T0, 1.0), ("b", T0, 2.0)], "city string, ts timestamp, ghi double")
    assert I.slice_city_range(df, "a", "2023-12-31", "2024-01-02").count() == 1
    with pytest.raises(ValueError):
        I.slice_city_range(df, "c", "2023-12-31", "2024-01-02")


def test_training_guard_refuses_recent(spark):
    from heliospark.sources import ingest as I

    df = I.stable_recent_split(
        spark.createDataFrame([(T0,), (T0 + dt.timedelta(days=10),)], "ts timestamp"), "2024-01-10", 2
    )
    with pytest.raises(Exception):
        I.guard_training_slice(df).collect()
    assert I.guard_training_slice(df, allow_recent=True).count() == 2


def test_partition_scoped_upsert(spark):
    from heliospark.sources import upsert as U

    schema = "city_name string, day string, timestamp timestamp, v double"
    target = spark.createDataFrame([("a", "d1", T0, 1.0), ("a", "d2", T0 + dt.timedelta(days=1), 2.0)], schema)
    batch = spark.createDataFrame([("a", "d2", T0 + dt.timedelta(days=1), 9.0)], schema)
    out = U.upsert_partitions(target, batch, ["city_name", "timestamp"], ["city_name", "day"]).collect()
    assert len(out) == 1 and out[0]["v"] == 9.0  # only the touched partition is rewritten


def test_coverage_all_failed_is_error(spark):
    from heliospark.sources import ingest as I

    exp = spark.createDataFrame([("a",), ("b",)], "city string")
    batch = spark.createDataFrame([], "city string")
    with pytest.raises(RuntimeError):
        I.assert_any_delivered(I.coverage(exp, batch))


def test_sequences_need_enough_rows(spark):
    from heliospark.operators import timeseries as TS

    df = spark.createDataFrame([("a", T0 + dt.timedelta(hours=h), 1.0) for h in range(5)], "city string, ts timestamp, ghi double")
    with pytest.raises(ValueError):
        TS.sequences(df, ["ghi"], "ghi", 24)
    ok = TS.sequences(df, ["ghi"], "ghi", 2).collect()
    assert len(ok) == 3 and all(len(r["sequence"]) == 2 for r in ok)


def test_coercion_zero_fill_historic_window_and_missing_keys(spark):
    from heliospark.sources import ingest as I

    df = spark.createDataFrame([("1.5", 2.0), ("bad", float("nan"))], "a string, b double")
    out = C.coerce_numeric(df, ["a", "b"]).collect()
    assert out[0]["a"] == 1.5 and out[1]["a"] is None and out[1]["b"] is None
    z = C.zero_fill(spark.createDataFrame([(1.0, None), (None, 2.0)], "t double, x double"), ["t"]).collect()
    assert len(z) == 1 and z[0]["x"] == 0.0
    lo, hi = I.historic_window("2025-06-10")
    row = spark.range(1).select(lo.alias("lo"), hi.alias("hi")).first()
    assert (row["lo"], row["hi"]) == (dt.date(2024, 6, 10), dt.date(2025, 6, 8))
    exp = spark.createDataFrame([("a",), ("b",)], "city string")
    got = I.missing_keys(exp, spark.createDataFrame([("a",)], "city string")).collect()
    assert [r["city"] for r in got] == ["b"]


def test_many_station_files_are_one_scan_a_header(spark):
    d = tempfile.mkdtemp(prefix="heliospark-test-many-")
    want = []
    for i in range(200):
        if i % 3 == 0:
            _csv(d, f"f{i:03d}.csv", f"TIMESTAMP,GHI,Tair_Avg\n2024-01-01 00:00:{i % 60:02d},{i},20\n2024-01-01 01:00:00,n/a,1\n2024-01-01 02:00:00,{i}.5,\n")
            want += [(f"f{i:03d}.csv", float(i)), (f"f{i:03d}.csv", i + 0.5)]
        elif i % 3 == 1:
            _csv(d, f"f{i:03d}.csv", f'Date,Time,"ghi",GHI\n2024-01-02,00:30:00,,{i}\n')
            want.append((f"f{i:03d}.csv", float(i)))
        else:
            _csv(d, f"f{i:03d}.csv", "Timestamp,Tamb\n2024-01-01,5\n" if i % 2 else "")  # no GHI, or empty
    out = SS.read_station_files(spark, [os.path.join(d, n) for n in os.listdir(d)] + [os.path.join(d, "missing.csv")])
    plan = out.select("ghi")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 2
    rows = sorted((r["source_file"], r["_row"], r["ghi"]) for r in out.collect())
    assert [(f, g) for f, _, g in rows] == sorted(want)  # file order, here that of the values
    assert len({(f, n) for f, n, _ in rows}) == len(rows)


def test_feature_files_are_few_and_pruned(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="heliospark-test-sink-"), "features")
    ts = F.timestamp_add("HOUR", F.col("id"), F.lit(T0))
    df = spark.range(4000).select(F.concat(F.lit("c"), F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 40)).alias("city"), ts.alias("ts"), F.rand(1).alias("x")).repartition(30)
    df = df.withColumn("slice", F.when(F.col("ts") < F.lit(T0 + dt.timedelta(hours=2000)), "stable").otherwise("recent"))
    TB.write_features(df, path, file_rows=300)
    back = TB.read_features(spark, path)
    assert back.count() == 4000 and sorted(map(tuple, back.select(*df.columns).collect())) == sorted(map(tuple, df.collect()))
    files = back.groupBy(F.col("_metadata.file_path").alias("f"), "city", "slice").agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("lo"), F.max("ts").alias("hi")).collect()
    assert max(r["n"] for r in files) <= 300
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert len(files) <= tasks + 42 + 4000 // 300  # tasks, partitions, and files cut for their size
    hot = sorted((r["slice"], r["lo"], r["hi"]) for r in files if r["city"] == "c0")
    assert all(a[0] != b[0] or a[2] < b[1] for a, b in zip(hot, hot[1:]))  # disjoint stretches of time
    one = back.where("city = 'c3' AND slice = 'stable'")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(city" in plan.lower().replace("partitionfilters", "PartitionFilters") and one.count() == df.where("city = 'c3' AND slice = 'stable'").count()


def _table(spark, rows, name):
    from heliospark.sources.upsert import UpsertTable

    schema = "city string, ts timestamp, v double, day date"
    df = spark.createDataFrame([(c, T0 + dt.timedelta(hours=h), v, (T0 + dt.timedelta(hours=h)).date()) for c, h, v in rows], schema)
    path = os.path.join(tempfile.mkdtemp(prefix="heliospark-test-table-"), name)
    return UpsertTable(spark, path, ["city", "ts"], ["city", "day"], df.schema), df


def _files(path):
    return {os.path.join(r, f) for r, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def _kept(table):
    return {(r["city"], r["ts"]): r["v"] for r in table.read().collect()}


def test_stored_upsert_touches_its_partitions_only(spark):
    table, first = _table(spark, [("a", h, float(h)) for h in range(48)] + [("b", h, 1.0) for h in range(24)], "t")
    assert table.read().count() == 0 and table.apply(first, 0)
    before = _files(table.path + "/data")
    _, second = _table(spark, [("a", 30, None), ("a", 50, 9.0)], "t")
    assert table.apply(second, 1) and not table.apply(second, 1) and not table.apply(first, 0)
    after = _files(table.path + "/data")
    assert {f for f in before if "day=2024-01-01" in f} <= after  # of both cities
    assert not {f for f in before if "city=a/day=2024-01-02" in f} & after
    want = {("a", T0 + dt.timedelta(hours=h)): float(h) for h in range(48)} | {("b", T0 + dt.timedelta(hours=h)): 1.0 for h in range(24)}
    want |= {("a", T0 + dt.timedelta(hours=30)): None, ("a", T0 + dt.timedelta(hours=50)): 9.0}
    assert _kept(table) == want
    # An empty delivery changes nothing but is committed.
    assert table.apply(second.limit(0), 2) and _kept(table) == want and table.last_commit() == 2


@pytest.mark.parametrize("after", ["staging", "data"])
def test_stored_upsert_after_a_break(spark, after):
    """A delivery that broke off after staging, or with the data written but not
    committed, is applied again with the same result."""
    table, first = _table(spark, [("a", h, float(h)) for h in range(24)], "t")
    table.apply(first, 0)
    _, second = _table(spark, [("a", 3, -1.0), ("a", 30, 5.0)], "t")
    if after == "staging":
        table._stage(second, 1, None)
    else:
        real = table.spark

        class Broken:
            def __getattr__(self, name):
                if name == "range":  # the commit's row
                    raise RuntimeError("lost before the commit")
                return getattr(real, name)

        table.spark = Broken()
        with pytest.raises(RuntimeError):
            table.apply(second, 1)
        table.spark = real
    assert table.last_commit() == 0 and table.apply(second, 1)
    got = _kept(table)
    assert len(got) == 25 and got[("a", T0 + dt.timedelta(hours=3))] == -1.0 and got[("a", T0 + dt.timedelta(hours=30))] == 5.0


def test_upsert_ties_of_one_sequence(spark):
    from heliospark.sources.upsert import upsert

    target = spark.createDataFrame([("k", 1.0, "t")], "k string, v double, w string")
    batch = spark.createDataFrame([("k", None, "z", None), ("k", 2.0, "a", None), ("j", 5.0, "x", 3), ("j", 5.0, "y", 3), ("j", 9.0, "q", 2)], "k string, v double, w string, s long")
    got = {r["k"]: (r["v"], r["w"], r["origin"]) for r in upsert(target, batch, ["k"], "s").collect()}
    assert got == {"k": (2.0, "a", "batch"), "j": (5.0, "y", "batch")}


@pytest.mark.parametrize("few, bins", [(10_000, 1024), (3, 4)])
def test_exact_quantiles(spark, few, bins):
    import numpy as np

    from heliospark.operators.quantiles import exact_quantiles

    rng = np.random.default_rng(3)
    groups = {
        "many": rng.normal(size=4000).round(2).tolist(),
        "one": [7.5],
        "same": [3.0] * 500,
        "wide": [*(10.0 ** rng.uniform(-300, 300, 200)).tolist(), -1e308, 1e308],
        "two": [1.0, 2.0],
        None: rng.integers(0, 5, 99).astype(float).tolist(),
        "none": [None, None],
    }
    rows = [(g, v) for g, values in groups.items() for v in values] + [("many", None)]
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    df = spark.createDataFrame(rows, "g string, v double").where("g IS NOT NULL")
    got = {(r["g"], r["prob"]): r["quantile"] for r in exact_quantiles(df, "g", "v", probs, bins, few).collect()}
    want = {(g, p): float(np.quantile(v, p)) for g, v in groups.items() if g not in (None, "none") for p in probs}
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k], rel=1e-12) for k in want if np.isfinite(want[k]))
    assert exact_quantiles(df.limit(0), "g", "v", probs).count() == 0


def test_stored_grid_is_built_once_for_each_state(spark):
    import shutil

    from heliospark.sources.grid_store import bucketed_table, input_state

    path = os.path.join(tempfile.mkdtemp(prefix="heliospark-test-grid-"), "in")
    spark.range(50).select((F.col("id") % 5).cast("string").alias("city"), F.timestamp_add("HOUR", F.col("id"), F.lit(T0)).alias("ts")).write.parquet(path)
    built = []

    def table():
        src = spark.read.parquet(path)
        return bucketed_table(spark, "test_grid", input_state(src), lambda: built.append(1) or src)

    first = table()
    assert first.count() == 50 and table().count() == 50 and len(built) == 1
    spark.range(3).select(F.lit("9").alias("city"), F.lit(T0).cast("timestamp").alias("ts")).write.mode("append").parquet(path)
    assert table().count() == 53 and len(built) == 2  # another state of the input
    shutil.rmtree(os.path.dirname(table().inputFiles()[0]).removeprefix("file:"))
    assert table().count() == 53 and len(built) == 3  # its files were lost
