"""Global row order without a single-partition window.

``Window.orderBy`` without ``partitionBy`` moves the whole table into one
task. Instead:

1. range-partition on the order key and sort inside partitions;
2. tag each row with ``monotonically_increasing_id`` (partition id in the
   high bits, position in the low 33 bits) and cut lineage with a reliable
   ``checkpoint()`` into the cluster's shared checkpoint folder, so a lost
   executor cannot re-sample range bounds and renumber rows;
3. count rows per partition (one row per partition), prefix-sum those
   counts on that tiny table, and broadcast it back: global index =
   partition offset + position.

Carries across partition edges (last / first non-NULL value) and halos for
row lags use the same tiny per-partition tables. Every broadcast here has
exactly one row per range partition, a size fixed by configuration.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

POS_BITS = 33
POS_MASK = (1 << POS_BITS) - 1


def with_global_index(
    df: DataFrame, order_cols: list[str | Column], idx: str = "gidx", num_partitions: int | None = None
) -> DataFrame:
    """Add a dense 0-based global row index in ``order_cols`` order, plus
    ``_pid`` (range partition) and ``_pos`` (position inside it)."""
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)
    tagged = materialize(ranged.withColumn("_mid", F.monotonically_increasing_id()))
    tagged = tagged.withColumn("_pid", F.shiftright("_mid", POS_BITS).cast("int")).withColumn(
        "_pos", F.col("_mid").bitwiseAND(F.lit(POS_MASK))
    )
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    # Window over one row per partition: bounded by the partition count.
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_pid",
        "_cnt",
        F.coalesce(F.sum("_cnt").over(w), F.lit(0)).alias("_off"),
        F.sum("_cnt").over(Window.partitionBy(F.lit(1))).alias("_total"),
    )
    out = tagged.join(F.broadcast(offsets), "_pid")
    return out.withColumn(idx, F.col("_off") + F.col("_pos")).drop("_mid")


def _series(by: tuple[str, ...]):
    """Windows over the table of one row per (``by``, range partition)."""
    return Window.partitionBy(*by) if by else Window


def carry_fill(df: DataFrame, cols: list[str], idx: str = "gidx", by: tuple[str, ...] = ()) -> DataFrame:
    """Previous / next non-NULL value and index per column in global order.

    ``df`` must come from :func:`with_global_index`. Inside a range partition
    the carry is a window partitioned by ``_pid`` (bounded by the partition
    size); across partitions it comes from a per-partition edge table.
    Nothing is carried between values of ``by``, the first columns of the order.
    """
    part = [*by, "_pid"]
    back = Window.partitionBy(*part).orderBy(idx).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # Running frame over descending order: incremental, unlike UNBOUNDED FOLLOWING.
    fwd = Window.partitionBy(*part).orderBy(F.col(idx).desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edge_aggs = []
    backs, fwds = [], []
    for c in cols:
        i_nn = F.when(F.col(c).isNotNull(), F.col(idx))
        backs += [F.max(i_nn).over(back).alias(f"_{c}_pi"), F.last(c, ignorenulls=True).over(back).alias(f"_{c}_pv")]
        fwds += [F.min(i_nn).over(fwd).alias(f"_{c}_ni"), F.last(c, ignorenulls=True).over(fwd).alias(f"_{c}_nv")]
        edge_aggs += [
            F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(idx))).alias(f"_{c}_lv"),
            F.max(i_nn).alias(f"_{c}_li"),
            F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(idx))).alias(f"_{c}_fv"),
            F.min(i_nn).alias(f"_{c}_fi"),
        ]
    # One ascending and one descending pass for all columns together.
    out = df.select("*", *backs).select("*", *fwds)
    edges = df.groupBy(*part).agg(*edge_aggs)
    # Carry tables: one row per partition.
    before = _series(by).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    after = _series(by).orderBy("_pid").rowsBetween(1, Window.unboundedFollowing)
    carry_cols = [*part]
    for c in cols:
        carry_cols += [
            F.last(f"_{c}_lv", ignorenulls=True).over(before).alias(f"_{c}_cpv"),
            F.max(f"_{c}_li").over(before).alias(f"_{c}_cpi"),
            F.first(f"_{c}_fv", ignorenulls=True).over(after).alias(f"_{c}_cnv"),
            F.min(f"_{c}_fi").over(after).alias(f"_{c}_cni"),
        ]
    carry = edges.select(*carry_cols)
    out = out.join(F.broadcast(carry), part)
    for c in cols:
        out = (
            out.withColumn(f"_{c}_pv", F.when(F.col(f"_{c}_pi").isNull(), F.col(f"_{c}_cpv")).otherwise(F.col(f"_{c}_pv")))
            .withColumn(f"_{c}_pi", F.coalesce(F.col(f"_{c}_pi"), F.col(f"_{c}_cpi")))
            .withColumn(f"_{c}_nv", F.when(F.col(f"_{c}_ni").isNull(), F.col(f"_{c}_cnv")).otherwise(F.col(f"_{c}_nv")))
            .withColumn(f"_{c}_ni", F.coalesce(F.col(f"_{c}_ni"), F.col(f"_{c}_cni")))
            .drop(f"_{c}_cpv", f"_{c}_cpi", f"_{c}_cnv", f"_{c}_cni")
        )
    return out


def interpolate_both(df: DataFrame, cols: list[str], idx: str = "gidx", by: tuple[str, ...] = ()) -> DataFrame:
    """Linear by row position, no limit; leading / trailing runs take the
    nearest value (pandas ``interpolate(limit_direction='both')`` + ffill/bfill)."""
    out = carry_fill(df, cols, idx, by)
    for c in cols:
        pi, pv, ni, nv = (F.col(f"_{c}_{s}") for s in ("pi", "pv", "ni", "nv"))
        interp = (nv - pv) / (ni - pi) * (F.col(idx) - pi) + pv
        filled = (
            F.when(F.col(c).isNotNull(), F.col(c))
            .when(pi.isNotNull() & ni.isNotNull(), interp)
            .when(pi.isNotNull(), pv)
            .otherwise(nv)
        )
        out = out.withColumn(c, filled).drop(f"_{c}_pi", f"_{c}_pv", f"_{c}_ni", f"_{c}_nv")
    return out


def with_halo(df: DataFrame, back: int, ahead: int, idx: str = "gidx") -> DataFrame:
    """Copy every row into the partitions that need it as context (P5).

    A row at global index g is also sent to each range partition q whose
    start lies in (g, g + back] (lag / trailing-frame context) and each q
    whose end lies in (g - ahead, g] (lead context), so windows partitioned
    by ``_pid`` see exact neighbours even when partitions are short. Rows
    keep ``_own`` = True only in their home partition. The partition bounds
    come from the per-partition table (one row per range partition).
    """
    bounds = sorted(
        (r["_pid"], r["_off"], r["_cnt"])
        for r in df.groupBy("_pid").agg(F.first("_off").alias("_off"), F.first("_cnt").alias("_cnt")).collect()
    )
    pids = F.array(*[F.lit(int(p)) for p, _, _ in bounds])
    starts = F.array(*[F.lit(int(o)) for _, o, _ in bounds])
    ends = F.array(*[F.lit(int(o + c)) for _, o, c in bounds])
    g = F.col(idx)
    k = F.sequence(F.lit(1), F.lit(len(bounds)))
    need_back = F.filter(k, lambda q: (F.element_at(starts, q) > g) & (F.element_at(starts, q) - back <= g))
    need_ahead = F.filter(k, lambda q: (F.element_at(ends, q) <= g) & (F.element_at(ends, q) + ahead > g))
    targets = F.transform(F.array_union(need_back, need_ahead), lambda q: F.element_at(pids, q))
    home = df.withColumn("_own", F.lit(True))
    # Only rows within ``back`` of their partition end or ``ahead`` of its
    # start can be context for another partition: (back + ahead) x partitions.
    edge_rows = df.filter((F.col("_pos") >= F.col("_cnt") - back) | (F.col("_pos") < ahead))
    copies = (
        edge_rows.withColumn("_to", F.explode(targets))
        .withColumn("_pid", F.col("_to"))
        .drop("_to")
        .withColumn("_own", F.lit(False))
    )
    return home.unionByName(copies)


def with_edges(df: DataFrame, order: str, cols: list[str], back: int, ahead: int, by: tuple[str, ...] = ()) -> DataFrame:
    """The rows around each range partition's own (P5), as arrays.

    ``df`` has the partitions ``_pid`` in global order and distinct ``order``
    values inside each. Every row gets its place ``_at`` in the partition and
    the number ``_left`` of rows after it; rows within ``back`` of the start
    (or ``ahead`` of the end) also get ``_before``: the last ``back`` rows of
    the partitions before, nearest last (``_after``: the first rows behind). A
    partition shorter than that is bridged. The arrays come from a table with
    one row per partition; no row is copied and nothing is collected. Rows of
    other values of ``by``, the first columns of the order, are not neighbours.
    """
    up = Window.partitionBy(*by, "_pid").orderBy(order)
    down = Window.partitionBy(*by, "_pid").orderBy(F.col(order).desc())
    placed = df.withColumns({"_at": F.row_number().over(up) - 1, "_left": F.row_number().over(down) - 1})
    row = F.struct(F.col(order).alias("_o"), *cols)
    ends = placed.where((F.col("_left") < back) | (F.col("_at") < max(ahead, 1))).groupBy(*by, "_pid").agg(
        F.array_sort(F.collect_list(F.when(F.col("_left") < back, row))).alias("_tail"),
        F.array_sort(F.collect_list(F.when(F.col("_at") < ahead, row))).alias("_head"),
    )
    # Each partition has a row at least, so ``back`` of them hold all that is asked for.
    past = _series(by).orderBy("_pid").rowsBetween(-max(back, 1), -1)
    next_ = _series(by).orderBy("_pid").rowsBetween(1, max(ahead, 1))
    edges = ends.select(
        *by,
        "_pid",
        F.slice(F.reverse(F.flatten(F.collect_list("_tail").over(past))), 1, back).alias("_before"),
        F.slice(F.flatten(F.collect_list("_head").over(next_)), 1, max(ahead, 1)).alias("_after"),
    ).select(*by, "_pid", F.reverse("_before").alias("_before"), "_after")
    near = (F.col("_at") < back) | (F.col("_left") < ahead)
    return placed.withColumn("_near", F.when(near, F.col("_pid"))).join(F.broadcast(edges.withColumnRenamed("_pid", "_near")), [*by, "_near"], "left").drop("_near")


def edge_lag(col: str, k: int, order: str, by: tuple[str, ...] = ()) -> Column:
    """The value ``k`` rows before (after, for negative ``k``) in global order;
    needs the columns of :func:`with_edges`."""
    w = Window.partitionBy(*by, "_pid").orderBy(order)
    if k < 0:
        beyond = F.get("_after", -k - 1 - F.col("_left"))[col]
        return F.when(F.col("_left") >= -k, F.lead(col, -k).over(w)).otherwise(beyond)
    place = F.size("_before") - (k - F.col("_at"))
    beyond = F.when(place >= 0, F.get("_before", place)[col])
    return F.when(F.col("_at") >= k, F.lag(col, k).over(w)).otherwise(beyond)
