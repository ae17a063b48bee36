"""Keyed upsert and table contracts.

The merge is one hash aggregate on the key: ``max_by(row, (source rank,
sequence))`` keeps the incoming row on conflict -- all metrics replaced, NULLs
included -- with partial aggregation before the shuffle. Keys are
(city, hour), so a hot city spreads over many reducers.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Room for every BIGINT sequence, negative ones included, within one rank.
RANK_STEP = 1 << 65


def delivery_order(rank: Column, seq: Column) -> Column:
    """Order by (rank, sequence) as one DECIMAL(38): exact for every BIGINT
    sequence, NULL lowest, and of fixed width, so that ``max_by`` stays a hash
    aggregate (a struct would force sort aggregation). Rank 0 with sequence 0 is 0."""
    step = F.lit(Decimal(RANK_STEP)).cast("decimal(38,0)")
    low = F.coalesce(seq.cast("long"), F.lit(-(1 << 63))).cast("decimal(20,0)")
    return (rank.cast("decimal(18,0)") * step + low).cast("decimal(38,0)")


def upsert(target: DataFrame, batch: DataFrame, keys: list[str], seq: str | None = None) -> DataFrame:
    """Rows of ``batch`` replace rows of ``target`` with equal ``keys``.

    Empty batch -> target unchanged. Duplicate keys inside one batch: the
    highest ``seq`` wins (Postgres would reject the statement; here the
    latest delivery wins deterministically); a NULL ``seq`` is the lowest.
    Among rows of a key and ``seq`` the one wins whose values, compared in
    column order with NULL lowest, are the greatest.
    """
    cols = [c for c in target.columns]
    vals = [c for c in cols if c not in keys]
    t = target.select(*cols, delivery_order(F.lit(0), F.lit(0)).alias("_ord"))
    b = batch.select(*cols, delivery_order(F.lit(1), F.col(seq) if seq else F.lit(0)).alias("_ord"))
    if seq:
        # Rows of one sequence, NULL included, would tie: one row stays of each.
        b = b.groupBy(*keys, "_ord").agg(F.max(F.struct(*vals)).alias("_v")).select(*keys, *[F.col(f"_v.{c}").alias(c) for c in vals], "_ord")
    u = t.unionByName(b)
    merged = u.groupBy(*keys).agg(*[F.max_by(c, "_ord").alias(c) for c in vals], F.max("_ord").alias("_ord"))
    return merged.select(
        *keys,
        *vals,
        F.when(F.col("_ord") > 0, F.lit("batch")).otherwise(F.lit("target")).alias("origin"),
    )


def contract_violations(df: DataFrame, keys: list[str], not_null: list[str], checks: dict[str, object]) -> DataFrame:
    """One row per rule with its violation count.

    ``checks`` maps a rule name to a boolean Column that is TRUE when a row
    violates it. Key uniqueness counts keys that occur more than once.
    """
    dup = df.groupBy(*keys).count().agg(F.count_if(F.col("count") > 1).alias("v"))
    row_rules = df.agg(
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in not_null],
        *[F.count_if(F.coalesce(cond, F.lit(False))).alias(name) for name, cond in checks.items()],
    )
    names = [f"null_{c}" for c in not_null] + list(checks)
    stack = ", ".join(f"'{n}', `{n}`" for n in names)
    rows = row_rules.selectExpr(f"stack({len(names)}, {stack}) AS (rule, violations)")
    keyrow = dup.select(F.lit("duplicate_key").alias("rule"), F.col("v").alias("violations"))
    return rows.unionByName(keyrow).select("rule", F.col("violations").cast("bigint").alias("violations"))


def request_rules() -> dict[str, Column]:
    """What a simulation request must not have, by rule name."""
    return {
        "negative_ghi": F.exists("hourly_ghi", lambda g: g < 0),
        "panel_count_below_1": F.col("panel_count") < 1,
        "rating_not_positive": F.col("panel_watt_rating") <= 0,
        "month_out_of_range": ~F.col("month").between(1, 12),
        "no_hours": F.coalesce(F.size("hourly_ghi"), F.lit(0)) < 1,
    }


def upsert_partitions(
    target: DataFrame, batch: DataFrame, keys: list[str], partition_cols: list[str], seq: str | None = None
) -> DataFrame:
    """S5 at scale: merge only the target partitions the batch touches.

    The batch's distinct partition values (e.g. city, date) semi-join the
    target, so the merge reads those partitions alone (the join's small side
    prunes the scan); untouched partitions are never read.
    """
    touched = batch.select(*partition_cols).distinct()
    affected = target.join(touched, partition_cols, "left_semi")
    return upsert(affected, batch, keys, seq)


class UpsertTable:
    """S5 as a stored table: deliveries merged into parquet partitions.

    ``path/data`` holds the rows, partitioned by ``partition_cols`` (of columns
    that are never NULL, as the table's contract has it);
    ``path/commits`` one row for each delivery that is in. A delivery is
    merged with the partitions it touches into ``path/staged``, from where
    dynamic partition overwrite replaces just those partitions; files of
    other partitions stay as they are. A delivery that broke off at any point
    can be applied again: staging starts anew, and rows that are already in
    are replaced by themselves. One that is committed, or older than the last
    commit, is left alone.
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str], partition_cols: list[str], schema: T.StructType) -> None:
        self.spark, self.path = spark, path
        self.keys, self.partition_cols, self.schema = keys, partition_cols, schema

    def read(self) -> DataFrame:
        """The rows of the table (none before the first delivery)."""
        if not has_data(self.spark, f"{self.path}/data"):
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/data").select(*self.schema.names)

    def last_commit(self) -> int:
        if not has_data(self.spark, f"{self.path}/commits"):
            return -1
        last = self.spark.read.schema("delivery long").parquet(f"{self.path}/commits").agg(F.max("delivery")).first()[0]
        return -1 if last is None else last

    def _stage(self, batch: DataFrame, delivery: int, seq: str | None) -> DataFrame:
        merged = upsert_partitions(self.read(), batch, self.keys, self.partition_cols, seq).drop("origin")
        staged = f"{self.path}/staged/{delivery}"
        merged.write.mode("overwrite").parquet(staged)
        return self.spark.read.schema(merged.schema).parquet(staged)

    def apply(self, batch: DataFrame, delivery: int, seq: str | None = None) -> bool:
        """Merge ``batch`` as delivery number ``delivery``; False if it is in already."""
        if delivery <= self.last_commit():
            return False
        staged = self._stage(batch, delivery, seq)
        # Rows of a partition meet in one task, in key order; hot partitions are split by AQE's rebalancing.
        rows = staged.hint("rebalance", *self.partition_cols).sortWithinPartitions(*self.partition_cols, *self.keys)
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*self.partition_cols).parquet(f"{self.path}/data")
        self.spark.range(1).select(F.lit(delivery).cast("long").alias("delivery")).write.mode("append").parquet(f"{self.path}/commits")
        remove_folder(self.spark, f"{self.path}/staged/{delivery}")
        return True


def has_data(spark: SparkSession, path: str) -> bool:
    """Whether anything has been written to ``path`` (readers bring their schema)."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def remove_folder(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
