"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_path


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def text_of(df: DataFrame, column: str = "text") -> Column:
    """The text column with NULL read as empty."""
    return F.coalesce(df[column], F.lit(""))


# Of the rows that a Python worker gets at once. Left to their number alone
# (10 000), whole texts make batches of any size, held by both sides.
BATCH_BYTES = 4 << 20


def batches_by_bytes(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: cuts
    lineage, survives a lost executor, and is computed once."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Delete the files of a table made by ``stored`` that nothing reads any more."""
    spark = table.sparkSession
    for folder in {f.rpartition("/")[0] for f in table.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def component_labels(edges: DataFrame, name: str = "components") -> DataFrame:
    """(a, b) undirected edges -> (node, component) with the smallest node id
    of each connected component (nodes without an edge are absent).

    Alternating large-star / small-star rounds: every round sends a node's
    larger neighbours, then its smaller ones, to the smallest, until the set
    of edges is a set of stars. Minima are hash aggregates (combined before
    the shuffle) and the joins on a hub's key are split by AQE; nothing but
    one fingerprint row per round reaches the driver.
    """
    cur = stored(edges.select("a", "b").where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    last = None
    while True:
        both = cur.select("a", "b").unionByName(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("n")).select("a", F.least("a", "n").alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b")  # no more rows than edges; the round ends with distinct ones
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.a", "e.b")
        cur, before = stored(small.where("a <> b").distinct(), name), cur
        discard(before)
        now = cur.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == last:
            break
        last = now
    return cur.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(cur.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
