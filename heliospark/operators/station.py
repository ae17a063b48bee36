"""Station feature frame in global time order.

The station series is ordered globally (all files interleaved by time), so
row-position operators use one range-partitioned global index from
``global_order`` instead of a single-partition window:

* T12 interpolation: in-partition windows + a per-partition carry table;
* T13 consolidation inside the range partitions; a timestamp that two
  partitions share is merged at the first of them;
* T14 row lags / rolling / next-row targets: windows per range partition
  whose rows beyond the edge come as arrays from a per-partition table.

The per-file mode (R4) keeps the files apart: the same steps in the order of
(source file, time), where nothing passes from one file to the next. A file
of any length is shared by as many range partitions as its rows fill.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import STATION_GHI_LAGS, STATION_NUMERIC
from ..functions.calendar import station_calendar_columns
from ..functions.numeric import EXACT, MOMENT, quantize, quantized_mean
from ..session import kept, materialize
from .clean import require_columns
from .global_order import edge_lag, interpolate_both, with_edges, with_global_index
from .timeseries import _finish_mean, _finish_std

TARGETS = ["target_ghi_next_1h", "target_temperature_next_1h"]


TASK_ROWS = 250_000  # of a range partition, as planned


def _partitions(st: DataFrame) -> int:
    return max(int(st.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-st.count() // TASK_ROWS))


def interpolate_station(st: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Linear by row position over all files (those of a value of ``by``),
    both ends filled."""
    present = [c for c in STATION_NUMERIC if c in st.columns]
    # Counted, sampled for the range bounds and written, but parsed once.
    with kept(st):
        n = _partitions(st)
        idx = with_global_index(st, list(dict.fromkeys([*by, "timestamp", "source_file", "_row"])), "gidx", n)
    # Dealt by number: left to the bytes shuffled, a few tasks would hold all partitions.
    out = interpolate_both(idx.repartition(n, *by, "_pid"), present, "gidx", by)
    return out.select("timestamp", *present, "source_file", "_row", "gidx", "_pid")


def _sums(cols: list[str]) -> list[Column]:
    return [e for c in cols for e in (F.sum(quantize(F.col(c)).cast(EXACT)).alias(f"_s_{c}"), F.count(quantize(F.col(c))).alias(f"_n_{c}"))]


def _means(cols: list[str]) -> list[Column]:
    return [quantized_mean(F.col(f"_s_{c}"), F.col(f"_n_{c}")).alias(c) for c in cols]


def consolidate(df: DataFrame, keys: tuple[str, ...] = ("timestamp",)) -> DataFrame:
    """One row per timestamp, mean of duplicates (exact, 1e-6 HALF_UP)."""
    present = [c for c in STATION_NUMERIC if c in df.columns]
    return df.groupBy(*keys).agg(*_sums(present)).select(*keys, *_means(present))


def consolidate_in_place(df: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """T13 inside the range partitions ``_pid`` of a frame in timestamp order."""
    present = [c for c in STATION_NUMERIC if c in df.columns]
    parts = df.groupBy(*by, "_pid", "timestamp").agg(*_sums(present))
    # A timestamp of several partitions is the first or last of each: two rows a partition.
    ends = df.groupBy(*by, "_pid").agg(F.min("timestamp").alias("_a"), F.max("timestamp").alias("_b"))
    ends = ends.select(*by, "_pid", F.explode(F.array_distinct(F.array("_a", "_b"))).alias("timestamp"))
    shared = ends.groupBy(*by, "timestamp").agg(F.min("_pid").alias("_home"), F.count(F.lit(1)).alias("_k")).where("_k > 1").select(*by, "timestamp", "_home")
    homed = parts.join(F.broadcast(shared), [*by, "timestamp"], "left")
    again = homed.where("_home IS NOT NULL").groupBy(*by, F.col("_home").alias("_pid"), "timestamp").agg(
        *[F.sum(f"_{k}_{c}").cast(t).alias(f"_{k}_{c}") for c in present for k, t in (("s", dict(parts.dtypes)[f"_s_{c}"]), ("n", "bigint"))]
    )
    whole = homed.where("_home IS NULL").select(*again.columns)
    return whole.unionByName(again).select(*by, "_pid", "timestamp", *_means(present))


def _features(df: DataFrame, keep: list[str], lag) -> DataFrame:
    """B9 and T14 given ``lag(column, rows)``; B27 on the result."""
    present = [c for c in STATION_NUMERIC if c in df.columns]
    base = df.select(
        *keep,
        "timestamp",
        *present,
        *station_calendar_columns("timestamp"),
        *[lag("ghi", k).alias(f"ghi_lag_{k}") for k in STATION_GHI_LAGS],
        lag("temperature", 1).alias("temp_lag_1"),
        lag("ghi", -1).alias("target_ghi_next_1h"),
        lag("temperature", -1).alias("target_temperature_next_1h"),
    )
    # The rolling frame is the three rows before, that is the first three lags.
    last = [F.col(f"ghi_lag_{k}") for k in (1, 2, 3)]

    def total(e) -> Column:
        return sum((F.coalesce(e(x), F.lit(0).cast("decimal(33,12)")) for x in last[1:]), F.coalesce(e(last[0]), F.lit(0).cast("decimal(33,12)")))

    moments = base.withColumns(
        {
            "_g3_n": sum((x.isNotNull().cast("int") for x in last[1:]), last[0].isNotNull().cast("int")),
            "_g3_s": total(lambda x: x.cast(EXACT)).cast("decimal(34,6)"),
            "_g3_m": total(lambda x: x.cast(MOMENT)).cast("decimal(26,6)"),
            "_g3_mm": total(lambda x: x.cast(MOMENT) * x.cast(MOMENT)),
        }
    )
    feats = moments.select(*base.columns, _finish_mean("g3").alias("ghi_rolling_mean_3h"), _finish_std("g3").alias("ghi_rolling_std_3h"))
    # Remaining feature NULLs -> 0 (lags at the head of the series).
    return feats.dropna(subset=TARGETS).fillna(0.0)


def station_features(st: DataFrame, global_order: bool = True) -> DataFrame:
    """B6 -> T12 -> T13 -> B9 -> T14 -> B27 on a harmonised station frame.

    In global order rows of all files follow each other by time, as one
    series; otherwise every file is a series of its own.
    """
    require_columns(st, ["timestamp", "ghi", "temperature", "source_file", "_row"])
    by = () if global_order else ("source_file",)
    present = [c for c in STATION_NUMERIC if c in st.columns]
    cons = materialize(consolidate_in_place(interpolate_station(st, by), by))
    cons = cons.repartition(_partitions(cons), *by, "_pid")
    edged = with_edges(cons, "timestamp", present, back=max(STATION_GHI_LAGS), ahead=1, by=by)
    return _features(edged, list(by), lambda c, k: edge_lag(c, k, "timestamp", by))
