"""Tables bucketed and sorted by a key and time, stored once and reused.

The regular grid after imputation is the input of every windowed feature.
Stored in buckets by city, each bucket one file in (city, ts) order, it gives
those windows their partitioning and order at the scan: plans above it have
neither an exchange nor a sort. A table is named by what it is made of (the
files of its input with their sizes and times), so a changed input makes a new
table and an unchanged one is read again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_path
from .upsert import has_data


def input_state(df: DataFrame) -> str:
    """Digest of the files that ``df`` reads: paths, sizes and times."""
    spark = df.sparkSession
    conf = spark._jsc.hadoopConfiguration()
    seen = []
    for name in sorted(df.inputFiles()):
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        status = path.getFileSystem(conf).getFileStatus(path)
        seen.append(f"{name} {status.getLen()} {status.getModificationTime()}")
    return hashlib.md5("\n".join(seen).encode()).hexdigest()[:16]


def _is_there(spark: SparkSession, table: str) -> bool:
    """Whether the catalog has the table and its folder still exists."""
    if not spark.catalog.tableExists(table):
        return False
    place = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").first()
    return place is not None and has_data(spark, place["data_type"])


def bucketed_table(spark: SparkSession, name: str, state: str, build: Callable[[], DataFrame], key: str = "city", ts: str = "ts", buckets: Callable[[], int] | None = None) -> DataFrame:
    """The table of ``build()`` in buckets by ``key``, sorted by (key, ts).

    ``buckets`` tells their number (the session's shuffle partitions if left
    out). Rows that ``build`` has dealt to as many tasks by ``key`` already are
    not shuffled again.

    It is written under the shared folder when the catalog has no table of
    this name and state yet; the catalog learns of it after the last file is
    committed, so a write that broke off leaves nothing to be read.
    """
    table = f"{name}_{state}"
    if not _is_there(spark, table):
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        df = build()
        n = buckets() if buckets else int(spark.conf.get("spark.sql.shuffle.partitions"))
        (
            df.repartition(n, F.col(key))
            .sortWithinPartitions(key, ts)
            .write.bucketBy(n, key)
            .sortBy(key, ts)
            .option("path", shared_path(spark, table))
            .saveAsTable(table)
        )
    return spark.table(table)
