"""Structured Streaming operators (ST1-ST4).

* ST1 ``file_stream``: a file-source stream over landed parquet / JSON.
* ST3 ``hourly_means_stream``: event-time tumbling hour per city with a
  watermark bounding the state; ``update`` output through ``foreachBatch``
  into a merge-on-read table keyed by (city, hour) and versioned by batch
  id, which also enforces the lateness bound (updates to windows that
  closed before the batch are discarded).
* ST2 ``UpsertLog``: every micro-batch is a partition of a log under its
  batch id; the table is read back with the S5 rule (latest batch, then the
  producer's delivery sequence, wins per key). A replayed batch replaces its
  own partition, so a restart after executor loss is idempotent. ``compact``
  folds the log up to a batch into a snapshot.
* ST1 ``payload_stream``: landed payload files to hourly rows, malformed
  records to a second sink.
* ST4 ``decision_stream``: stateless B11-B14 over a stream of hourly rows,
  written with the exactly-once parquet file sink.

Sinks and checkpoints live under the session's shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import HOURLY_VARIABLES, CoolingConfig
from ..functions import decisions as D
from ..functions.numeric import exact_sum
from ..session import shared_path
from ..sources.payload import HOURLY_SCHEMA, payload_rows
from ..sources.upsert import delivery_order, has_data, remove_folder


def file_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", glob: str | None = None,
                max_files: int | None = None) -> DataFrame:
    """ST1: a streaming read of landed files with an explicit schema."""
    r = spark.readStream.schema(schema).format(fmt)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files:
        r = r.option("maxFilesPerTrigger", str(max_files))
    return r.load(path)


def _write_batch(sink: str):
    """foreachBatch writer: a batch is one partition, written again by a replay."""

    def write(df: DataFrame, batch_id: int) -> None:
        rows = df.withColumn("_batch", F.lit(batch_id).cast("bigint"))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_batch").parquet(sink)

    return write


def run_available_now(query_builder, checkpoint: str):
    """Start a stream that drains everything available, then stops."""
    q = query_builder.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return q


def _close_late_windows(sink: str, progress: str, lateness_hours: int | None):
    """foreachBatch writer for windowed aggregates with a strict lateness bound.

    Spark's watermark evicts window state but does not refuse late rows: a
    row older than the watermark re-creates its (already emitted) window and
    would be emitted again as a partial value. Here the watermark in force
    before batch ``b`` is rebuilt from a progress table (one row per batch:
    the largest event time seen) and every update to a window that had
    already closed is discarded, so the earlier complete value stands; the
    progress table counts what was discarded. Without a bound nothing is.
    """

    def write(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        seen = spark.read.parquet(progress).filter(F.col("batch") < batch_id).agg(F.max("max_ts")).first()[0]
        # Two writes read the batch: keep its rows, or the state side runs twice.
        rows = df.persist()
        late = F.lit(False)
        if seen is not None and lateness_hours is not None:
            late = F.col("window_end") <= F.timestamp_add("HOUR", F.lit(-lateness_hours), F.lit(seen))
        batch = F.lit(batch_id).cast("bigint")
        rows.filter(~late).drop("max_ts", "window_end").withColumn("_batch", batch).write.mode("append").parquet(sink)
        rows.agg(F.max("max_ts").alias("max_ts"), F.count_if(late).alias("n_late")).select(
            batch.alias("batch"), "max_ts", "n_late"
        ).write.mode("append").parquet(progress)
        rows.unpersist()

    return write


def hourly_means_stream(readings: DataFrame, lateness_hours: int | None = None, name: str = "hourly") -> DataFrame:
    """ST3: streaming hourly mean per city; returns the settled result table.

    With ``lateness_hours`` a watermark bounds the aggregation state, and the
    sink discards (and counts) updates to windows that closed before the
    batch (see ``_close_late_windows``). By default a late correction, however
    late, updates its hour.
    """
    spark = readings.sparkSession
    sink, ckpt = shared_path(spark, f"{name}-sink"), shared_path(spark, f"{name}-ckpt")
    progress = sink + "-progress"
    spark.createDataFrame([], "batch bigint, max_ts timestamp, n_late bigint").write.mode("overwrite").parquet(progress)
    timed = readings if lateness_hours is None else readings.withWatermark("ts", f"{lateness_hours} hours")
    agg = (
        timed.groupBy("city", F.window("ts", "1 hour").alias("w"))
        .agg(
            exact_sum("ghi").alias("_sg"),
            F.count("ghi").alias("_ng"),
            exact_sum("temp").alias("_st"),
            F.count("temp").alias("_nt"),
            F.max("ts").alias("max_ts"),
        )
        .select(
            "city",
            F.col("w.start").alias("ts"),
            F.col("w.end").alias("window_end"),
            "max_ts",
            F.when(F.col("_ng") > 0, F.col("_sg").cast("double") / F.col("_ng")).alias("ghi"),
            F.when(F.col("_nt") > 0, F.col("_st").cast("double") / F.col("_nt")).alias("temp"),
        )
    )
    writer = _close_late_windows(sink, progress, lateness_hours)
    run_available_now(agg.writeStream.outputMode("update").foreachBatch(writer), ckpt)
    return settle(spark.read.parquet(sink), ["city", "ts"])


def settle(versions: DataFrame, keys: list[str], seq: str | None = None, keep_order: bool = False) -> DataFrame:
    """Merge-on-read: the latest (batch id, sequence) row per key.

    The batch outranks any sequence; a NULL sequence is the lowest. With
    ``keep_order`` the winner's batch id and sequence stay.
    """
    vals = [c for c in versions.columns if c not in keys and (keep_order or c not in ("_batch", seq))]
    v = versions.withColumn("_ord", delivery_order(F.col("_batch"), F.col(seq) if seq else F.lit(0)))
    return v.groupBy(*keys).agg(*[F.max_by(c, "_ord").alias(c) for c in vals])


class UpsertLog:
    """ST2: a keyed table as a log of delivered batches and a snapshot.

    ``path/log/_batch=n`` holds what batch n delivered; ``path/snapshots/upto=n``
    the settled rows of all batches up to n, with their order; ``path/commits``
    names the snapshots that are complete. Readers take the last committed
    snapshot and the batches after it, so compaction can break off anywhere: a
    snapshot without its commit is not read and is written again, and batches
    that a committed snapshot covers are skipped whether or not they have been
    deleted yet, also when the stream replays one of them.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: list[str], seq: str) -> None:
        self.spark, self.path, self.keys, self.seq = spark, path, keys, seq
        self.schema = T.StructType([f for f in schema.fields]).add("_batch", "long")

    def append(self, deliveries: DataFrame) -> None:
        """Take in all that a stream of deliveries has to offer."""
        run_available_now(deliveries.writeStream.foreachBatch(_write_batch(f"{self.path}/log")), f"{self.path}/checkpoint")

    def _covered(self) -> int:
        if not has_data(self.spark, f"{self.path}/commits"):
            return -1
        last = self.spark.read.schema("upto long").parquet(f"{self.path}/commits").agg(F.max("upto")).first()[0]
        return -1 if last is None else last

    def versions(self, upto: int | None = None) -> DataFrame:
        """Snapshot rows and the rows of later batches (up to a batch)."""
        covered = self._covered()
        tail = F.col("_batch") > covered if upto is None else F.col("_batch").between(covered + 1, upto)
        rows = self.spark.createDataFrame([], self.schema)
        if has_data(self.spark, f"{self.path}/log"):
            rows = self.spark.read.schema(self.schema).parquet(f"{self.path}/log").where(tail)
        if covered >= 0:
            rows = rows.unionByName(self.spark.read.schema(self.schema).parquet(f"{self.path}/snapshots/upto={covered}"))
        return rows

    def read(self) -> DataFrame:
        return settle(self.versions(), self.keys, self.seq)

    def write_snapshot(self, upto: int) -> None:
        """The settled rows up to a batch, not yet read by anyone."""
        kept = settle(self.versions(upto), self.keys, self.seq, keep_order=True)
        kept.write.mode("overwrite").parquet(f"{self.path}/snapshots/upto={upto}")

    def commit_snapshot(self, upto: int) -> None:
        """Let readers take a snapshot, then delete what it covers."""
        covered = self._covered()
        self.spark.range(1).select(F.lit(upto).cast("long").alias("upto")).write.mode("append").parquet(f"{self.path}/commits")
        for batch in range(covered + 1, upto + 1):
            remove_folder(self.spark, f"{self.path}/log/_batch={batch}")
        if covered >= 0:
            remove_folder(self.spark, f"{self.path}/snapshots/upto={covered}")

    def compact(self, upto: int | None = None) -> int:
        """Fold the log up to a batch (the last one) into a snapshot; returns the batch."""
        last = self.versions().agg(F.max("_batch")).first()[0]
        upto = last if upto is None else upto
        if upto is None or upto <= self._covered():
            return self._covered()
        self.write_snapshot(upto)
        self.commit_snapshot(upto)
        return upto


def upsert_stream(deliveries: DataFrame, keys: list[str], seq: str, name: str = "upsert") -> DataFrame:
    """ST2: keyed upsert of a stream of deliveries; returns the settled table."""
    spark = deliveries.sparkSession
    log = UpsertLog(spark, shared_path(spark, f"{name}-sink"), deliveries.schema, keys, seq)
    log.append(deliveries)
    return log.read().drop(seq)


PAYLOAD_RECORD = T.StructType([T.StructField("city", T.StringType()), T.StructField("hourly", HOURLY_SCHEMA), T.StructField("_corrupt", T.StringType())])


def payload_stream(spark: SparkSession, landing: str, path: str, max_files: int | None = None) -> tuple[DataFrame, DataFrame]:
    """ST1: landed payload files (a JSON record a line: ``city``, ``hourly``) to
    hourly rows, and what could not be used.

    Rows are settled by (city_name, timestamp), the latest batch first, then
    the later file name. A line that is no JSON, or has no city, no ``hourly`` object or
    no time array goes to a second sink with its file and the reason; unusable
    hours inside a good payload are dropped (S1). Both sinks are partitioned
    by batch id, so a replayed batch replaces what it wrote.
    """
    lines = spark.readStream.option("recursiveFileLookup", "true")
    if max_files:
        lines = lines.option("maxFilesPerTrigger", str(max_files))
    parsed = F.from_json("value", PAYLOAD_RECORD, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    reason = (
        F.when(F.col("r._corrupt").isNotNull(), "malformed")
        .when(F.col("r.city").isNull(), "no city")
        .when(F.col("r.hourly").isNull(), "no hourly object")
        .when(F.col("r.hourly.time").isNull(), "no time array")
    )
    records = lines.text(landing).select("value", parsed.alias("r"), F.col("_metadata.file_name").alias("file"))
    records = records.where(F.trim("value") != "").select("value", "r.city", "r.hourly", reason.alias("reason"), "file")

    good, bad = _write_batch(f"{path}/hourly"), _write_batch(f"{path}/rejected")

    def write(df: DataFrame, batch_id: int) -> None:
        # Two writes read the batch: keep its rows, or the files are parsed twice.
        rows = df.persist()
        bad(rows.where("reason IS NOT NULL").select("file", "reason", "city", F.col("value").alias("record")), batch_id)
        good(payload_rows(rows.where("reason IS NULL").select(F.col("city").alias("city_name"), F.struct("hourly").alias("p"), "file"), ["file"]), batch_id)
        rows.unpersist()

    run_available_now(records.writeStream.foreachBatch(write), f"{path}/checkpoint")
    hourly = spark.read.parquet(f"{path}/hourly")
    rejected = spark.read.schema("file string, reason string, city string, record string, _batch long").parquet(f"{path}/rejected")
    # Rows of one key in one batch: the file name decides, as a delivery's name carries its time.
    last = hourly.groupBy("city_name", "timestamp").agg(F.max(F.struct("_batch", "file", *[c for c in HOURLY_VARIABLES])).alias("_r"))
    return last.select("city_name", "timestamp", *[F.col(f"_r.{c}").alias(c) for c in HOURLY_VARIABLES]), rejected.drop("_batch")


def decision_stream(hourly: DataFrame, cfg: CoolingConfig = CoolingConfig(), name: str = "decisions") -> DataFrame:
    """ST4: stateless decision rows over a stream, exactly-once file sink."""
    spark = hourly.sparkSession
    sink, ckpt = shared_path(spark, f"{name}-sink"), shared_path(spark, f"{name}-ckpt")
    dec = D.with_decision(hourly, cfg)
    run_available_now(dec.writeStream.format("parquet").option("path", sink).outputMode("append"), ckpt)
    return spark.read.parquet(sink)
