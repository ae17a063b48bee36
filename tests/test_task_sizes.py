"""Tasks and buckets sized by the rows of the grid."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import SMALL
from heliospark.operators import timeseries as TS
from heliospark.plans import common
from pyspark.sql import functions as F

T0 = dt.datetime(2024, 1, 1)


def _sparse(spark, cities=40, span=500):
    """Two readings a city, ``span`` hours apart: the grid has 250 rows a reading."""
    ts = F.timestamp_add("HOUR", F.pmod(F.col("id"), F.lit(2)) * (span - 1), F.lit(T0))
    return spark.range(2 * cities).select(
        F.concat(F.lit("c"), F.floor(F.col("id") / 2)).alias("city"), ts.alias("ts"), F.col("id").cast("double").alias("ghi"), F.lit(1.0).alias("temp")
    )


def test_grid_tasks_follow_grid_rows_not_readings(spark):
    df = _sparse(spark)
    assert TS.grid_rows(df) == 40 * 500 == TS.hourly_grid(df).count()
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert TS.tasks_for(spark, 3000) == 1 and TS.tasks_for(spark, 10**6) == usual
    assert -(-(10**9) // TS.tasks_for(spark, 10**9)) <= TS.TASK_ROWS
    filled = TS.impute(TS.hourly_grid(df, tasks=16))
    rows = [n for n in filled.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert len(rows) > usual and max(r["count"] for r in rows) < 20_000 / 4
    assert sorted(map(tuple, filled.collect())) == sorted(map(tuple, TS.impute(TS.hourly_grid(df)).collect()))


def test_grids_of_the_plans_are_dealt_by_number(spark):
    plan = common.sites_grid(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan


def test_stored_grid_has_buckets_for_its_rows(spark):
    table = TS.with_lags(common.stored_grid(spark, SMALL).select("city", "ts", "ghi", "temp"))
    rows = table.count()
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert f"out of {TS.tasks_for(spark, rows)}" in plan


def test_scaler_is_bound_as_literals(spark):
    df = spark.createDataFrame([("a", T0, 1.0), ("a", T0, 3.0)], "city string, ts timestamp, temp double")
    out = TS.apply_scaler(df, TS.scaler_params(df, ["temp"]))
    assert [r["temp"] for r in out.orderBy("temp").collect()] == [-1.0, 1.0]
    assert "scalar-subquery" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_training_tasks_follow_rows(spark, monkeypatch):
    from heliospark.config import BoostedTreeParams
    from heliospark.operators import models as M

    seen = []

    class Fit:
        def fit(self, rows):
            seen.append((rows.rdd.getNumPartitions(), rows.count()))
            return self

        def getStages(self):
            return [self]

    monkeypatch.setattr(M, "boosted_tree_estimator", lambda *_: Fit())
    rows = spark.range(300).repartition(60).selectExpr("id + 0.5D AS x", "id + 1D AS y", "'train' AS split")
    M.train_targets(rows, ["x"], {"t": "y"}, BoostedTreeParams())
    monkeypatch.setattr(M, "TRAIN_TASK_ROWS", 100)
    M.train_targets(rows, ["x"], {"t": "y"}, BoostedTreeParams())
    assert seen == [(1, 300), (3, 300)]


def test_a_file_is_shared_by_range_partitions(spark, monkeypatch):
    """Series by file, cut into many partitions: no window holds a whole file."""
    from heliospark.operators import station as ST

    ts = F.timestamp_add("MINUTE", F.floor(F.col("id") / 2) * 7, F.lit(T0))
    st = spark.range(600).select(
        ts.alias("timestamp"),
        F.when(F.col("id") % 3 > 0, F.col("id") * 1.5).alias("ghi"),
        F.when(F.col("id") % 5 > 1, F.col("id") * 0.25).alias("temperature"),
        F.when(F.col("id") % 10 == 0, "b").otherwise("a").alias("source_file"),
        F.col("id").alias("_row"),
    )
    monkeypatch.setattr(ST, "_partitions", lambda _: 1)
    want = ST.station_features(st, global_order=False)
    monkeypatch.setattr(ST, "_partitions", lambda _: 24)
    got = ST.station_features(st, global_order=False)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert all("_pid" in line for line in plan.splitlines() if " Window [" in line and "timestamp" in line)
    cons = ST.consolidate_in_place(ST.interpolate_station(st, ("source_file",)), ("source_file",))
    assert cons.where("source_file = 'a'").select("_pid").distinct().count() > 12


def test_training_tasks_stop_following_rows(spark, monkeypatch):
    """every pass of a fit starts all tasks, so beyond some their rows grow, up to what a task keeps."""
    from heliospark.operators import models as M

    assert [M.training_tasks(n) for n in (0, 1, 20_001, 480_000, 4_800_000, 9_600_000)] == [1, 1, 2, 24, 24, 24]
    assert M.training_tasks(22_600_000) == 57
    monkeypatch.setattr(M, "TRAIN_TASK_ROWS", 10)
    assert M.training_tasks(300) == 24


def test_station_rows_are_made_once(spark):
    """the count and the sample of the range bounds do not parse the files again."""
    from heliospark.operators import models as M
    from heliospark.operators import station as ST

    made = spark.sparkContext.accumulator(0)

    def seen(v):
        made.add(1)
        return v

    ts = F.timestamp_add("MINUTE", F.col("id").cast("int") * 7, F.lit(T0))
    reading = F.udf(seen, "double")(F.col("id").cast("double"))
    st = spark.range(60).select(ts.alias("timestamp"), reading.alias("ghi"), F.lit(20.0).alias("temperature"), F.lit("a.csv").alias("source_file"), F.col("id").alias("_row"))
    assert ST.interpolate_station(st).count() == 60
    assert made.value == 60
    frame = spark.range(60).select("id", F.udf(seen, "double")(F.col("id").cast("double")).alias("x"))
    assert M.chronological_split(frame, ["id"], 0.8).where("split = 'train'").count() == 48
    assert made.value == 120


def test_kept_frames_are_let_go(spark):
    from heliospark.session import kept

    df = spark.range(7).selectExpr("id * 3 AS kept_once")
    with kept(df) as rows:
        assert rows.storageLevel.useMemory
        with kept(rows):
            pass
        assert rows.storageLevel.useMemory  # its owner keeps it
    assert not df.storageLevel.useMemory and not df.storageLevel.useDisk


def test_plain_times_parse_like_the_others(spark):
    from heliospark.sources.payload import parse_wall_time

    days = ["2024-01-05", "2024-02-29", "2023-02-29", "0000-01-01", "2024-13-01", "2024-00-10"]
    texts = [f"{d} {t}" for d in days for t in ("00:00:00", "23:59:59", "24:00:00", "12:60:00", "12:00:61", "03:04:05\n")]
    df = spark.createDataFrame([(x,) for x in [*texts, " 2024-01-05 03:04:05 ", "2024-01-05 3:04:05"]], "t string")
    # An offset keeps a text from the plain path and is dropped.
    spelt = F.concat(F.trim(F.regexp_replace("t", "\n", "")), F.lit("Z"))
    got = df.select("t", parse_wall_time(F.col("t")).cast("string").alias("a"), parse_wall_time(spelt).cast("string").alias("b")).collect()
    assert all(r["a"] == r["b"] for r in got), [r for r in got if r["a"] != r["b"]]
    assert sum(r["a"] is not None for r in got) == 10  # three days, year 0 among them, three times each, and the padded text


def test_station_score_fits_every_tree(spark, monkeypatch):
    """both targets with the station parameters as the reference has them, 500 trees among them."""
    from heliospark.config import STATION_TREE_PARAMS
    from heliospark.operators import models as M
    from heliospark.plans import catalog

    class Fits(Exception):
        pass

    def fits(df, features, labels, params):
        raise Fits(params, sorted(labels))

    monkeypatch.setattr(M, "train_targets", fits)
    catalog.load_all()
    with pytest.raises(Fits) as asked:
        catalog.QUERIES["station_train_score"](spark, SMALL)
    params, targets = asked.value.args
    assert params == STATION_TREE_PARAMS and targets == ["ghi", "temperature"]
    assert (params.max_iter, params.max_depth, params.subsampling_rate, params.step_size) == (500, 6, 0.9, 0.05)
    assert M.boosted_tree_estimator(["x"], "y", params).getStages()[-1].getMaxIter() == 500
