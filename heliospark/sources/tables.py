"""Table scans, source precedence, feature sink/reader, metrics registry
(S3, S4, S7, S8, S10, S11, B2, O1, O2)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..functions.numeric import no_nan
from ..operators.clean import parse_utc_strict, require_columns

WEATHER_COLUMNS = ("city", "ts", "ghi", "temp")


@dataclass(frozen=True)
class Source:
    """A candidate source: a catalog table name or a parquet path, plus the
    expressions that map its columns onto ``city, ts, ghi, temp``."""

    name: str
    mapping: dict[str, str]
    is_path: bool = False


def weather_scan(df: DataFrame, mapping: dict[str, str], order: bool = False) -> DataFrame:
    """S3: projected, aliased scan; only mapped columns reach the reader, and
    NaN is read as NULL here, once for all operators above.

    Sorting (O1) is optional and meant for sinks only; an empty source is an
    error raised by the caller via :func:`require_non_empty`.
    """
    out = df.select(*[F.expr(src).alias(dst) for dst, src in mapping.items()])
    out = out.select(*[no_nan(c).alias(c) if t in ("double", "float") else F.col(c) for c, t in out.dtypes])
    return out.orderBy("city", "ts") if order else out


def require_non_empty(df: DataFrame, what: str = "source") -> DataFrame:
    """Fail fast on an empty input (one-row probe, no full count)."""
    if df.isEmpty():
        raise ValueError(f"{what} returned no rows")
    return df


def _exists(spark: SparkSession, src: Source) -> bool:
    if not src.is_path:
        return spark.catalog.tableExists(src.name)
    try:
        spark.read.parquet(src.name).schema  # noqa: B018 (metadata only)
        return True
    except AnalysisException:
        return False


def first_existing(spark: SparkSession, candidates: Sequence[Source], required=WEATHER_COLUMNS) -> DataFrame:
    """The first candidate that exists, mapped and checked (B1)."""
    for src in candidates:
        if _exists(spark, src):
            raw = spark.read.parquet(src.name) if src.is_path else spark.table(src.name)
            return require_columns(weather_scan(raw, src.mapping), required)
    raise ValueError(f"none of the sources exist: {[c.name for c in candidates]}")


FILE_BYTES = 256 << 20  # of a feature file, by Spark's estimate of the matrix
FILE_ROWS = 5_000_000
MOST_CITIES = 1000  # with a folder each; more of them share folders
GROUP_ROWS = 1_000_000  # of a shared folder, as planned
GROUP = "city_group"


def write_features(
    df: DataFrame, path: str, split_col: str | None = "slice", ts: str = "ts", file_rows: int = FILE_ROWS, most_cities: int = MOST_CITIES
) -> None:
    """Feature matrix sink, partitioned by city (and slice when present)
    so readers prune partitions; written with dynamic partition overwrite.

    Rows are first dealt by ranges of (city, slice, time): a task holds a few
    neighbouring partitions or a stretch of one, so it opens those files only,
    a hot city is shared by several tasks, and files cover disjoint stretches
    of time. There are at most tasks + partitions files, and none has over
    ``file_rows`` rows.

    Over ``most_cities`` cities are not given a folder each, as folders, files
    and their commits would then outnumber the work: they share folders by
    hash (``city_group``), sorted by city, whose place in a file its footer tells.
    """
    split = [split_col] if split_col and split_col in df.columns else []
    size = df.agg(F.count_distinct("city").alias("cities"), F.count(F.lit(1)).alias("rows")).first()
    if size["cities"] > most_cities:
        # Windows by city leave the rows dealt by city: no rows are ranked a
        # second time to find ranges, and a task writes a folder (a slice).
        groups = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size["rows"] // GROUP_ROWS))
        parts, order = [GROUP, *split], [*split, "city", ts]
        last = [c for c in df.columns if c not in ("city", *split)]
        dealt = df.select(*last, "city", *split).withColumn(GROUP, F.pmod(F.hash("city"), F.lit(groups))).repartition(groups, F.col("city"))
    else:
        estimate = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
        tasks = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-min(estimate, 1 << 50) // FILE_BYTES))
        parts = ["city", *split]
        order = [*parts, ts]
        dealt = df.repartitionByRange(tasks, *order)
    (
        dealt.sortWithinPartitions(*dict.fromkeys([*parts, *order]))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", str(file_rows))
        .partitionBy(*parts)
        .parquet(path)
    )


def read_features(spark: SparkSession, path: str, ts: str = "ts") -> DataFrame:
    """Reject an empty matrix and any unparseable timestamp (B2)."""
    df = spark.read.parquet(path).drop(GROUP)
    require_columns(df, ["city", ts])
    return require_non_empty(parse_utc_strict(df, ts), f"feature matrix at {path}")


def append_registry(metrics: DataFrame, path: str, run_id: str) -> None:
    """Append one row per (model, target) with the run id and time."""
    (
        metrics.withColumn("run_id", F.lit(run_id))
        .withColumn("recorded_at", F.current_timestamp())
        .write.mode("append")
        .parquet(path)
    )


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_holdout(scored: DataFrame, path: str, label: str = "actual", prediction: str = "predicted") -> None:
    """Holdout predictions with their residuals, a partition a model."""
    rows = scored.withColumn("residual", F.col(label) - F.col(prediction))
    rows.write.mode("overwrite").partitionBy("model_name").parquet(path)


def write_importances(importances: DataFrame, path: str) -> None:
    """The features of a model, the most important first (a row a feature)."""
    importances.orderBy(F.col("importance").desc(), F.col("feature")).coalesce(1).write.mode("overwrite").parquet(path)
