"""Structured Streaming: watermark lateness bound and idempotent merge-on-read."""

from __future__ import annotations

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from heliospark.streaming import jobs as P

SCHEMA = "city string, ts timestamp, ghi double, temp double"


def test_late_rows_beyond_watermark_are_dropped(spark):
    landing = tempfile.mkdtemp(prefix="heliospark-test-landing-")
    first = [("a", dt.datetime(2024, 1, 1, h, 10), 100.0, 20.0) for h in (10, 11, 12)]
    late_and_fresh = [("a", dt.datetime(2024, 1, 1, 7, 30), 999.0, 99.0), ("a", dt.datetime(2024, 1, 1, 12, 40), 300.0, 22.0)]
    spark.createDataFrame(first, SCHEMA).coalesce(1).write.parquet(os.path.join(landing, "b0"))
    spark.createDataFrame(late_and_fresh, SCHEMA).coalesce(1).write.parquet(os.path.join(landing, "b1"))
    stream = (
        spark.readStream.schema(SCHEMA)
        .option("maxFilesPerTrigger", "1")
        .option("recursiveFileLookup", "true")
        .parquet(landing)
    )
    out = {r["ts"].hour: r for r in P.hourly_means_stream(stream, 2, "test-late").collect()}
    assert 7 not in out  # 07:30 is older than max event time (12:10) - 2 h
    assert out[12]["ghi"] == 200.0  # 12:10 and 12:40 averaged across batches
    assert out[10]["ghi"] == 100.0


def test_settle_keeps_latest_batch_and_sequence(spark):
    rows = [("k", 1.0, 0, 0), ("k", 2.0, 1, 0), ("k", 3.0, 1, 5), ("j", None, 2, 0), ("j", 4.0, 0, 0)]
    v = spark.createDataFrame(rows, "key string, v double, _batch long, seq long")
    out = {r["key"]: r["v"] for r in P.settle(v, ["key"], "seq").collect()}
    assert out == {"k": 3.0, "j": None}  # a NULL in the latest delivery overwrites


def _log(spark, batches):
    """A log that has taken in some batches, one stream run each."""
    schema = "k string, v double, seq long"
    landing = tempfile.mkdtemp(prefix="heliospark-test-log-")
    log = P.UpsertLog(spark, os.path.join(tempfile.mkdtemp(prefix="heliospark-test-upsert-"), "log"), spark.createDataFrame([], schema).schema, ["k"], "seq")

    def deliver(rows):
        name = f"d{len(os.listdir(landing))}"
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(os.path.join(landing, name))
        log.append(spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(landing))

    for rows in batches:
        deliver(rows)
    return log, deliver


def _settled(log):
    return {r["k"]: r["v"] for r in log.read().collect()}


BATCHES = [[("a", 1.0, 9), ("b", 1.0, 0)], [("a", 2.0, 1), ("c", 2.0, 0)], [("a", 3.0, 0), ("b", None, 0)]]


def test_log_compaction_keeps_the_table(spark):
    log, deliver = _log(spark, BATCHES[:2])
    want = {"a": 2.0, "b": 1.0, "c": 2.0}
    assert _settled(log) == want and log.compact() == 1 and _settled(log) == want
    assert not [d for d in os.listdir(log.path + "/log") if d in ("_batch=0", "_batch=1")]  # folded and gone
    deliver(BATCHES[2])
    want = {"a": 3.0, "b": None, "c": 2.0}
    assert _settled(log) == want and log.compact() == 2 and _settled(log) == want
    assert os.listdir(log.path + "/snapshots") == ["upto=2"] and log.compact() == 2


def test_log_compaction_after_a_break(spark):
    """Broken off between the snapshot and its commit, or between the commit and
    the deletions; and a batch that the stream replays after it was folded."""
    log, _ = _log(spark, BATCHES)
    want = {"a": 3.0, "b": None, "c": 2.0}
    log.write_snapshot(1)  # lost before the commit: nobody reads it
    assert _settled(log) == want and log._covered() == -1
    remove = P.remove_folder
    P.remove_folder = lambda *_: (_ for _ in ()).throw(RuntimeError("lost"))
    try:
        log.compact(1)
    except RuntimeError:
        pass
    finally:
        P.remove_folder = remove
    assert log._covered() == 1 and os.path.exists(log.path + "/log/_batch=0") and _settled(log) == want
    replayed = spark.createDataFrame(BATCHES[0], "k string, v double, seq long")
    P._write_batch(log.path + "/log")(replayed, 0)
    assert _settled(log) == want and log.compact() == 2 and _settled(log) == want


def test_empty_log(spark):
    log, _ = _log(spark, [])
    assert _settled(log) == {} and log.compact() == -1


def test_payload_files_to_hours_and_rejects(spark):
    import json

    landing = tempfile.mkdtemp(prefix="heliospark-test-payload-")

    def land(name, lines):
        with open(os.path.join(landing, name), "w") as f:
            f.write("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines))

    hours = ["2024-01-01T00:00", "2024-01-01T01:00+05:00", "not a time"]
    land("a.json", [{"city": "x", "hourly": {"time": hours, "temperature_2m": [1.0, None, 3.0], "cloud_cover": [5.0]}}, "", "{broken", {"city": "x"}])
    land("b.json", [{"hourly": {"time": []}}, {"city": "y", "hourly": {}}, {"city": "y", "hourly": {"time": []}}, {"city": "z", "hourly": {"time": "one"}}])
    path = os.path.join(tempfile.mkdtemp(prefix="heliospark-test-payloads-"), "out")
    hourly, rejected = P.payload_stream(spark, landing, path, max_files=1)
    assert sorted((r["city_name"], r["timestamp"].hour, r["temperature_2m"], r["cloud_cover"], r["shortwave_radiation"]) for r in hourly.collect()) == [("x", 0, 1.0, 5.0, None), ("x", 1, None, None, None)]
    assert sorted((r["file"], r["reason"]) for r in rejected.collect()) == [
        ("a.json", "malformed"), ("a.json", "no hourly object"), ("b.json", "malformed"), ("b.json", "no city"), ("b.json", "no time array")]
    # A later file corrects an hour; running the stream again takes in nothing twice.
    land("c.json", [{"city": "x", "hourly": {"time": hours[:1], "temperature_2m": [8.0]}}])
    for _ in range(2):
        hourly, rejected = P.payload_stream(spark, landing, path)
    assert {r["timestamp"].hour: r["temperature_2m"] for r in hourly.collect()} == {0: 8.0, 1: None} and rejected.count() == 5
