"""Hourly time-series operators.

Partitioning argument (why per-city windows are safe at scale): every window
here runs on the *regularised hourly grid*, never on raw readings. Raw rows
are first reduced by ``groupBy(city, hour)`` -- a hash shuffle on the
composite key with map-side partial aggregation, so a city holding a third
of all raw rows is spread over many tasks. After that a city has at most one
row per hour of its history (8 760 rows per year), independent of raw
volume, so ``Window.partitionBy(city)`` partitions stay bounded even for a
hot city. All windows share one ``(city) / ts`` spec, so Spark plans one
exchange and one sort for the whole chain (P1).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import LAG_HOURS, ImputeConfig
from ..functions.calendar import cyclical_columns, local_ts
from ..session import materialize
from .global_order import with_edges, with_global_index
from ..functions.numeric import EXACT, MOMENT, exact_avg, mean_of_nonnull, quantize, quantized_mean

KEY = "city"
TS = "ts"
BASE = ("ghi", "temp")


def city_window(key: str | list[str] = KEY, ts: str = TS):
    keys = [key] if isinstance(key, str) else list(key)
    return Window.partitionBy(*keys).orderBy(ts)


# -- T1 ---------------------------------------------------------------------

def hourly_means(df: DataFrame, features=BASE, key: str = KEY, ts: str = TS) -> DataFrame:
    """T1 step 1: floor to the hour, mean of duplicates ignoring NULLs."""
    return df.groupBy(F.col(key).alias(key), F.date_trunc("hour", F.col(ts)).alias(ts)).agg(
        *[exact_avg(c).alias(c) for c in features]
    )


TASK_ROWS = 400_000  # grid rows in a task, at most as planned
SMALL_TASK_ROWS = 20_000  # worth a task of its own while there are shuffle partitions left


def tasks_for(spark: SparkSession, rows: int) -> int:
    """Tasks for ``rows`` grid rows: as many as the session's shuffle partitions
    if each gets enough, more of them when they would pass ``TASK_ROWS``."""
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(1, -(-rows // TASK_ROWS), min(usual, -(-rows // SMALL_TASK_ROWS)))


def grid_rows(df: DataFrame, key: str = KEY, ts: str = TS) -> int:
    """Rows of the hourly grid of ``df``: one aggregate over key and time."""
    hour = F.unix_seconds(F.date_trunc("hour", F.col(ts)))
    spans = df.groupBy(key).agg(((F.max(hour) - F.min(hour)) / 3600 + 1).cast("bigint").alias("n"))
    return spans.agg(F.sum("n")).first()[0] or 0


def hourly_grid(
    df: DataFrame, features=BASE, key: str = KEY, ts: str = TS, means: DataFrame | None = None, tasks: int | None = None
) -> DataFrame:
    """Hourly means on a gapless per-city grid [own min, own max].

    Adds ``i`` = hours since the city's first hour (grid position), which lets
    gap arithmetic use plain subtraction instead of extra windows.

    ``tasks`` deals the cities to that many tasks. Left to the size of what is
    shuffled, that is the readings, a few tasks would hold the many times more
    rows that the gaps become, in every sort of the windows above.
    """
    h = means if means is not None else hourly_means(df, features, key, ts)
    if tasks:
        h = h.repartition(tasks, F.col(key))
    # Each hour stands for itself and the missing hours up to the next one, so
    # the grid needs no second scan and no join, and an array is one gap long.
    # The window's exchange by city is the one that later city windows reuse.
    w = city_window(key, ts)
    hour = F.expr("INTERVAL 1 HOUR")
    t0 = F.first(ts).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    marked = h.select("*", F.lead(ts).over(w).alias("_next"), t0.alias("_t0"))
    hours = F.sequence(F.col(ts), F.coalesce(F.col("_next") - hour, F.col(ts)), hour)
    values = [c for c in h.columns if c not in (key, ts)]
    return marked.select(key, F.col(ts).alias("_own"), "_t0", *values, F.explode(hours).alias(ts)).select(
        key,
        ts,
        ((F.unix_seconds(F.col(ts)) - F.unix_seconds(F.col("_t0"))) / 3600).cast("bigint").alias("i"),
        *[F.when(F.col(ts) == F.col("_own"), F.col(c)).alias(c) for c in values],
    )


# -- P3: time-block shards with halo rows ------------------------------------

def shard_blocks(grid: DataFrame, block_hours: int, back: int, ahead: int) -> DataFrame:
    """Give every grid row its home block ``_blk = i // block_hours`` and copy
    it into the neighbouring block when it lies within ``back`` rows of the
    block end or ``ahead`` rows of the block start (``_own`` = False there).

    Windows partitioned by (city, ``_blk``) then see every neighbour they
    need, and each window partition holds at most block + back + ahead rows
    however long a city's history is. Membership is arithmetic on the grid
    index: no extra pass, nothing collected.
    """
    if back > block_hours or ahead > block_hours:
        raise ValueError("halo must not exceed the block length")
    i = F.col("i")
    blk = F.floor(i / block_hours).cast("bigint")
    pos = i - blk * block_hours
    copies = F.array(
        F.struct(blk.alias("b"), F.lit(True).alias("own")),
        F.when(pos >= block_hours - back, F.struct((blk + 1).alias("b"), F.lit(False).alias("own"))),
        F.when(pos < ahead, F.struct((blk - 1).alias("b"), F.lit(False).alias("own"))),
    )
    c = F.explode(F.filter(copies, lambda x: x.isNotNull())).alias("_c")
    return grid.select("*", c).select("*", F.col("_c.b").alias("_blk"), F.col("_c.own").alias("_own")).drop("_c")


# -- T2 / T3 ----------------------------------------------------------------

def _neighbours(df: DataFrame, cols: str | list[str], key: str | list[str] = KEY, ts: str = TS) -> DataFrame:
    """Previous / next non-NULL value and grid index for each of ``cols``.

    All backward carries are one projection (one ascending sort) and all
    forward carries another (one descending sort), whatever the number of
    columns.
    """
    cols = [cols] if isinstance(cols, str) else list(cols)
    back = city_window(key, ts).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # "Next non-NULL" as a running frame over descending time: Spark evaluates
    # running frames incrementally (O(n)); an UNBOUNDED FOLLOWING frame would
    # be re-aggregated for every row (O(n^2) per city).
    keys = [key] if isinstance(key, str) else list(key)
    fwd = Window.partitionBy(*keys).orderBy(F.col(ts).desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    backs, fwds = [], []
    for col in cols:
        idx = F.when(F.col(col).isNotNull(), F.col("i"))
        backs += [F.max(idx).over(back).alias(f"_{col}_pi"), F.last(col, ignorenulls=True).over(back).alias(f"_{col}_pv")]
        fwds += [F.min(idx).over(fwd).alias(f"_{col}_ni"), F.last(col, ignorenulls=True).over(fwd).alias(f"_{col}_nv")]
    return df.select("*", *backs).select("*", *fwds)


def gap_runs(grid: DataFrame, col: str = "ghi", long_after: int = 3, key: str = KEY, ts: str = TS) -> DataFrame:
    """One row per NULL run of ``col``: bounds, length, long flag, position."""
    n = _neighbours(grid.select(key, ts, "i", col), col, key, ts)
    nulls = n.filter(F.col(col).isNull())
    runs = nulls.groupBy(key, F.coalesce(F.col(f"_{col}_pi"), F.lit(-1)).alias("_run")).agg(
        F.min(ts).alias("run_start"),
        F.max(ts).alias("run_end"),
        F.count(F.lit(1)).alias("run_length"),
        F.max(F.col(f"_{col}_ni").isNull().cast("int")).alias("_trailing"),
    )
    return runs.select(
        key,
        "run_start",
        "run_end",
        F.col("run_length").cast("bigint").alias("run_length"),
        (F.col("run_length") > long_after).alias("is_long"),
        F.when(F.col("_run") < 0, F.lit("leading"))
        .when(F.col("_trailing") == 1, F.lit("trailing"))
        .otherwise(F.lit("interior"))
        .alias("position"),
    )


def short_gap_fill(df: DataFrame, col: str, out: str, max_gap: int = 3) -> Column:
    """T3 expression (needs ``_neighbours`` columns): interior runs <= max_gap."""
    pi, pv, ni, nv = (F.col(f"_{col}_{s}") for s in ("pi", "pv", "ni", "nv"))
    interp = (nv - pv) / (ni - pi) * (F.col("i") - pi) + pv
    return F.coalesce(F.col(col), F.when((ni - pi - 1) <= max_gap, interp)).alias(out)


# -- T3..T6 -----------------------------------------------------------------

def impute(
    grid: DataFrame, cfg: ImputeConfig = ImputeConfig(), key: str = KEY, ts: str = TS, shard_hours: int | None = None
) -> DataFrame:
    """Tiered imputation per feature, then the GHI night mask.

    Tier 1 (T3) short interior gaps, linear; tier 2 (T4) mean of the same hour
    on the previous ``history_days`` days, from the tier-1 series (not
    recursively filled); tier 3 (T5) mean by (city, local month, local hour)
    of the tier-2 series. Output keeps ``<f>_source`` labels per cell.
    """
    wkeys: str | list[str] = key
    src = grid
    if shard_hours:
        # Tiers 1-2 reach back 24 x history_days rows (+ the interpolation
        # context of the oldest one) and short_gap_max rows ahead.
        src = shard_blocks(grid, shard_hours, 24 * cfg.history_days + cfg.short_gap_max, cfg.short_gap_max)
        wkeys = [key, "_blk"]
    w = city_window(wkeys, ts)
    out = _neighbours(src, list(cfg.features), wkeys, ts)
    out = out.select("*", *[short_gap_fill(out, f, f"_{f}_s1", cfg.short_gap_max) for f in cfg.features])
    lt = local_ts(F.col(ts))
    out = out.withColumn("_lmonth", F.month(lt)).withColumn("_lhour", F.hour(lt))
    s2 = []
    for f in cfg.features:
        s1 = F.col(f"_{f}_s1")
        hist = mean_of_nonnull([F.lag(s1, 24 * k).over(w) for k in range(1, cfg.history_days + 1)])
        s2.append(F.coalesce(s1, hist).alias(f"_{f}_s2"))
    out = out.select("*", *s2)
    if shard_hours:
        out = out.filter(F.col("_own")).drop("_own", "_blk")
    clim_w = Window.partitionBy(key, "_lmonth", "_lhour")
    out = out.select("*", *[x for f in cfg.features for x in _exact(f"_{f}_s2", f"c{f}")])
    out = out.select("*", *[m for f in cfg.features for m in _frame_moments(f"c{f}", clim_w)])
    out = out.select("*", *[F.coalesce(F.col(f"_{f}_s2"), _finish_mean(f"c{f}")).alias(f"_{f}_s3") for f in cfg.features])
    night = (F.col("_lhour") >= cfg.night_start_hour) | (F.col("_lhour") <= cfg.night_end_hour)
    cols = [key, ts, "i"]
    for f in cfg.features:
        raw, s1, s2, s3 = (F.col(c) for c in (f, f"_{f}_s1", f"_{f}_s2", f"_{f}_s3"))
        source = (
            F.when(raw.isNotNull(), F.lit("observed"))
            .when(s1.isNotNull(), F.lit("interpolated"))
            .when(s2.isNotNull(), F.lit("history"))
            .when(s3.isNotNull(), F.lit("climatology"))
            .otherwise(F.lit("missing"))
        )
        value = s3
        if f == "ghi":
            value = F.when(night, F.lit(0.0)).otherwise(s3)
            source = F.when(night, F.lit("night")).otherwise(source)
        cols += [value.alias(f), source.alias(f"{f}_source")]
    return out.select(*cols)


def impute_counts(grid: DataFrame, imputed: DataFrame, features=BASE, key: str = KEY) -> DataFrame:
    """T6 count: NULL cells per city before and after imputation."""
    before = grid.groupBy(key).agg(
        sum(F.count_if(F.col(f).isNull()) for f in features).alias("missing_before"),
        F.count(F.lit(1)).alias("grid_rows"),
    )
    after = imputed.groupBy(key).agg(sum(F.count_if(F.col(f).isNull()) for f in features).alias("missing_after"))
    return before.join(after, key).select(
        key,
        F.col("grid_rows").cast("bigint").alias("grid_rows"),
        F.col("missing_before").cast("bigint").alias("missing_before"),
        F.col("missing_after").cast("bigint").alias("missing_after"),
        (F.col("missing_before") - F.col("missing_after")).cast("bigint").alias("filled"),
    )


# -- B8, T7-T10 -------------------------------------------------------------

def with_cyclical(df: DataFrame, ts: str = TS) -> DataFrame:
    """B8 (raw hour / month are not kept)."""
    return df.select("*", *cyclical_columns(ts))


def with_lags(df: DataFrame, features=BASE, lags=LAG_HOURS, key: str = KEY, ts: str = TS) -> DataFrame:
    """Row lags per city (hour lags on the regular grid)."""
    w = city_window(key, ts)
    return df.select("*", *[F.lag(f, k).over(w).alias(f"{f}_lag_{k}") for f in features for k in lags])


def _exact(c: str, tag: str, second: bool = False) -> list[Column]:
    """``c`` (and its square) as the exact decimals that frames add up, made
    once a row; inside a frame each row would be converted for every frame
    that it is part of."""
    x = F.col(c).cast(MOMENT)
    out = [F.col(c).cast(EXACT).alias(f"_{tag}_x")]
    return out + [x.alias(f"_{tag}_y"), (x * x).alias(f"_{tag}_yy")] if second else out


def _frame_moments(tag: str, w, second: bool = False) -> list[Column]:
    """Exact frame count / sum (/ sum of squares) of the ``_exact`` columns.

    Each window aggregate is computed once; the mean and sigma expressions
    then read these columns (referencing a window expression several times
    would make Spark evaluate it several times).
    """
    out = [F.count(f"_{tag}_x").over(w).alias(f"_{tag}_n"), F.sum(f"_{tag}_x").over(w).alias(f"_{tag}_s")]
    if second:
        out += [F.sum(f"_{tag}_y").over(w).alias(f"_{tag}_m"), F.sum(f"_{tag}_yy").over(w).alias(f"_{tag}_mm")]
    return out


def _finish_mean(tag: str) -> Column:
    """Frame mean, exact and rounded HALF_UP at 1e-6."""
    return quantized_mean(F.col(f"_{tag}_s"), F.col(f"_{tag}_n"))


def _finish_std(tag: str) -> Column:
    """Sample sigma from exact DECIMAL moments (>= 2 values, else NULL)."""
    n = F.col(f"_{tag}_n")
    sx = F.col(f"_{tag}_m").cast("double")
    sxx = F.col(f"_{tag}_mm").cast("double")
    var = (sxx - sx * sx / n) / (n - 1)
    return F.when(n >= 2, quantize(F.sqrt(F.greatest(var, F.lit(0.0)))))


def _rolling_select(df: DataFrame, w) -> DataFrame:
    """T8 columns on ``df`` for window spec ``w`` (frames end at t-1)."""
    w3 = w.rowsBetween(-3, -1)
    w6 = w.rowsBetween(-6, -1)
    exact = df.select("*", *_exact("ghi", "g3", second=True), *_exact("temp", "t6"))
    tmp = exact.select("*", *_frame_moments("g3", w3, second=True), *_frame_moments("t6", w6))
    return tmp.select(
        *df.columns,
        _finish_mean("g3").alias("ghi_rolling_mean_3h"),
        _finish_std("g3").alias("ghi_rolling_std_3h"),
        _finish_mean("t6").alias("temp_rolling_mean_6h"),
    )


def with_rolling(df: DataFrame, key: str = KEY, ts: str = TS) -> DataFrame:
    """Leakage-safe rolling statistics ending at t-1.

    Frame sums are exact DECIMAL sums, so the result does not depend on the
    order in which an engine folds the frame.
    """
    return _rolling_select(df, city_window(key, ts))


def with_targets(df: DataFrame, key: str = KEY, ts: str = TS) -> DataFrame:
    """Next-hour targets; rows with a NULL target are dropped."""
    w = city_window(key, ts)
    return df.select(
        "*",
        F.lead("ghi", 1).over(w).alias("target_ghi_next_1h"),
        F.lead("temp", 1).over(w).alias("target_temp_next_1h"),
    ).dropna(subset=["target_ghi_next_1h", "target_temp_next_1h"])


def with_features(df: DataFrame, key: str = KEY, ts: str = TS, shard_hours: int | None = None) -> DataFrame:
    """B8 + T7 + T8 + T9 in one windowed pass (optionally P3-sharded: halo of
    max(lag) rows back and one row ahead for the next-hour targets)."""
    src = with_cyclical(df, ts)
    keys: str | list[str] = key
    if shard_hours:
        src = shard_blocks(src, shard_hours, max(LAG_HOURS), 1)
        keys = [key, "_blk"]
    w = city_window(keys, ts)
    lagged = src.select(
        "*",
        *[F.lag(f, k).over(w).alias(f"{f}_lag_{k}") for f in BASE for k in LAG_HOURS],
        F.lead("ghi", 1).over(w).alias("target_ghi_next_1h"),
        F.lead("temp", 1).over(w).alias("target_temp_next_1h"),
    )
    out = _rolling_select(lagged, w)
    order = [c for c in out.columns if not c.startswith("target_")] + ["target_ghi_next_1h", "target_temp_next_1h"]
    out = out.select(*order)
    if shard_hours:
        out = out.filter(F.col("_own")).drop("_own", "_blk")
    return out.dropna(subset=["target_ghi_next_1h", "target_temp_next_1h"])


# The continuous features; GHI itself, calendar and target columns stay as they
# are. Which ones are scaled is fixed by the format of the feature matrix.
CONTINUOUS = ("temp", *(f"{f}_lag_{k}" for f in BASE for k in LAG_HOURS), "ghi_rolling_mean_3h", "ghi_rolling_std_3h", "temp_rolling_mean_6h")


def scaled_columns(columns: list[str]) -> list[str]:
    """Those of ``columns`` that standardisation applies to."""
    return [c for c in CONTINUOUS if c in set(columns)]


def _moments(cols: list[str]) -> list[Column]:
    out = []
    for i, c in enumerate(cols):
        x = F.col(c).cast(MOMENT)
        out += [F.count(c).alias(f"n{i}"), F.sum(x).alias(f"sx{i}"), F.sum(x * x).alias(f"sxx{i}")]
    return out


def _mean_std(i: int, prefix: str = "") -> tuple[Column, Column]:
    n = F.col(f"{prefix}n{i}")
    sx = F.col(f"{prefix}sx{i}").cast("double")
    sxx = F.col(f"{prefix}sxx{i}").cast("double")
    mean = F.when(n > 0, sx / n)
    std = F.when(n > 0, F.sqrt(F.greatest((sxx - sx * sx / n) / n, F.lit(0.0))))
    return mean, std


def scaler_params(df: DataFrame, cols: list[str]) -> DataFrame:
    """T10 fit: one row per column with mean and population sigma (NULLs ignored)."""
    stats = df.agg(*_moments(cols))
    ms = []
    for i, _ in enumerate(cols):
        m, sd = _mean_std(i)
        ms += [m.alias(f"m{i}"), sd.alias(f"s{i}")]
    stack = ", ".join(f"'{c}', m{i}, s{i}" for i, c in enumerate(cols))
    return stats.select(*ms).selectExpr(f"stack({len(cols)}, {stack}) AS (feature, mean, std)")


def standardise(
    df: DataFrame, cols: list[str] | None = None, fit_on: DataFrame | None = None, checkpoint_input: bool = True
) -> DataFrame:
    """z = (x - mean) / sigma with population sigma; sigma 0 -> 1.

    The fit is one global aggregate of exact moments (partial aggregation on
    every partition, one small merge); its single result row -- two numbers
    per column, computed by Spark -- is bound into the projection as
    literals. ``fit_on`` lets callers fit on the training slice only.
    """
    cols = cols or scaled_columns(df.columns)
    if fit_on is None and checkpoint_input:
        # The fit and the transform both need the full input; cut lineage once
        # (reliable checkpoint in the shared folder) instead of computing the
        # upstream window chain twice.
        df = materialize(df)
    src = fit_on if fit_on is not None else df
    moments = src.agg(*_moments(cols))
    fitted = moments.select(
        *[e.alias(f"{k}{i}") for i in range(len(cols)) for k, e in zip(("m", "s"), _mean_std(i))]
    ).first()
    repl = {}
    for i, c in enumerate(cols):
        mean, sd = fitted[f"m{i}"], fitted[f"s{i}"]
        denom = 1.0 if sd is None or sd == 0 else sd
        repl[c] = ((F.col(c) - F.lit(mean).cast("double")) / F.lit(denom)).alias(c)
    return df.select(*[repl.get(c, F.col(c)) for c in df.columns])


def apply_scaler(df: DataFrame, params: DataFrame) -> DataFrame:
    """T10 on new rows with saved parameters (feature, mean, std): two numbers
    per column, bound into the projection as literals. (Taken from a subquery
    inside it, their lookups make it too long a method for the JVM to compile.)"""
    cols = scaled_columns(df.columns)
    fitted = params.agg(
        *[F.max(F.when(F.col("feature") == c, F.col(v))).alias(f"{v}_{c}") for c in cols for v in ("mean", "std")]
    ).first()
    scaled = {}
    for c in cols:
        mean, std = fitted[f"mean_{c}"], fitted[f"std_{c}"]
        scaled[c] = ((F.col(c) - F.lit(mean).cast("double")) / F.lit(std if std is not None and std > 0 else 1.0)).alias(c)
    return df.select(*[scaled.get(c, F.col(c)) for c in df.columns])


# -- T16, T17 ---------------------------------------------------------------

def sequences(
    df: DataFrame,
    features: list[str],
    label: str,
    n: int = 24,
    key: str = KEY,
    ts: str = TS,
    dtype: str = "double",
    require_rows: bool = True,
) -> DataFrame:
    """The ``n`` preceding rows' feature vectors (current row excluded).

    Rows with fewer than ``n`` predecessors emit nothing. Bounded: each output
    row carries exactly ``n`` small structs.
    """
    w = city_window(key, ts).rowsBetween(-n, -1)
    vec = F.array(*[F.col(f).cast(dtype) for f in features])
    seq = F.collect_list(vec).over(w)
    out = df.select(key, ts, seq.alias("sequence"), F.col(label).alias("label")).filter(F.size("sequence") == n)
    if require_rows and out.isEmpty():
        raise ValueError(f"not enough rows to build sequences of length {n}")
    return out


def sequences_global(df: DataFrame, features: list[str], label: str, n: int = 24, order: tuple[str, ...] = ("ts", "city"), dtype: str = "double") -> DataFrame:
    """T16 in global order (R4): the ``n`` rows before in the order of all rows,
    across keys. Range partitions with arrays of the rows beyond their edges."""
    idx = with_global_index(df, list(order), "gidx")
    vec = F.array(*[F.col(f).cast(dtype) for f in features])
    edged = with_edges(idx.withColumn("_vec", vec), "gidx", ["_vec"], back=n, ahead=0)
    own = F.collect_list("_vec").over(Window.partitionBy("_pid").orderBy("gidx").rowsBetween(-n, -1))
    # The nearest rows before the partition make up what is missing.
    missing = F.lit(n) - F.size(own)
    before = F.coalesce(F.transform("_before", lambda r: r["_vec"]), F.array().cast(f"array<array<{dtype}>>"))
    taken = F.least(missing, F.size(before))
    seq = F.concat(F.slice(before, F.size(before) - taken + 1, taken), own)
    return edged.select(*order, seq.alias("sequence"), F.col(label).alias("label")).filter(F.size("sequence") == n)


def daily_profile(hourly: DataFrame, key: str = KEY, ts: str = TS) -> DataFrame:
    """24 UTC hour slots for every (city, date) present; missing -> NULL."""
    days = hourly.select(key, F.to_date(ts).alias("date")).distinct()
    spine = days.select(key, "date", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour"))
    h = hourly.select(key, F.to_date(ts).alias("date"), F.hour(ts).alias("hour"), "ghi", "temp")
    return spine.join(h, [key, "date", "hour"], "left")
