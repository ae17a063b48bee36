"""Exact quantiles per group by distributed selection.

No group is sorted or collected. Every wanted order statistic keeps an
interval of values that holds it and its rank inside. A round counts the
group's values of the interval in ``bins`` equal parts; the part where the
running count passes the rank, from its least to its greatest value, is the
next interval. It ends when an interval is one value, or holds few enough
values that ranking them is a bounded window. Every round at least splits off
the extremes, and all values but those of the intervals drop out after the
first, so rounds are few and get cheaper.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

BINS = 1024
FEW = 10_000  # values of an interval that are ranked in one task


def exact_quantiles(df: DataFrame, group: str, value: str, probs: list[float], bins: int = BINS, few: int = FEW) -> DataFrame:
    """(group, prob, quantile): linear interpolation between order statistics of
    the non-NULL values; groups without values have no row."""
    data = df.select(F.col(group).alias("_g"), F.col(value).cast("double").alias("_v")).where("_v IS NOT NULL")
    sizes = data.groupBy("_g").agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    places = F.array(*[F.struct(F.lit(p).alias("prob"), ((F.col("_n") - 1) * F.lit(float(p))).alias("at")) for p in probs])
    wanted = materialize(sizes.select("_g", "_n", "_lo", "_hi", F.explode(places).alias("_p")).select("_g", "_n", "_lo", "_hi", "_p.prob", "_p.at"))
    ranks = wanted.select("_g", "_n", "_lo", "_hi", F.explode(F.array_distinct(F.array(F.floor("at"), F.ceil("at")))).alias("_rank")).distinct()
    # (group, wanted rank): the interval, the rank inside it, and how many values it holds.
    open_ = ranks.select("_g", "_rank", "_lo", "_hi", F.col("_rank").alias("_in"), F.col("_n").alias("_c"))
    found = None
    while True:
        open_ = materialize(open_)
        done = open_.where("_lo = _hi").select("_g", "_rank", F.col("_lo").alias("_value"))
        found = done if found is None else found.unionByName(done)
        small = open_.where((F.col("_lo") < F.col("_hi")) & (F.col("_c") <= few))
        inside = data.join(small.select("_g", "_rank", "_lo", "_hi", "_in"), "_g").where("_v BETWEEN _lo AND _hi")
        order = Window.partitionBy("_g", "_rank").orderBy("_v")
        found = found.unionByName(inside.withColumn("_k", F.row_number().over(order) - 1).where("_k = _in").select("_g", "_rank", F.col("_v").alias("_value")))
        open_ = open_.where((F.col("_lo") < F.col("_hi")) & (F.col("_c") > few))
        if open_.isEmpty():
            break
        inside = data.join(open_.select("_g", "_rank", "_lo", "_hi", "_in"), "_g").where("_v BETWEEN _lo AND _hi")
        # Halves, so that the width of an interval stays finite.
        part = F.least(F.floor((F.col("_v") / 2 - F.col("_lo") / 2) / (F.col("_hi") / 2 - F.col("_lo") / 2) * bins), F.lit(bins - 1))
        counts = inside.groupBy("_g", "_rank", "_in", part.alias("_part")).agg(F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
        before = F.sum("_c").over(Window.partitionBy("_g", "_rank").orderBy("_part")) - F.col("_c")  # at most ``bins`` rows
        cut = counts.withColumn("_before", before).where("_before <= _in AND _in < _before + _c")
        open_ = cut.select("_g", "_rank", "_lo", "_hi", (F.col("_in") - F.col("_before")).alias("_in"), "_c")
    pairs = wanted.select("_g", "prob", "at", F.floor("at").alias("_a"), F.ceil("at").alias("_b"))
    low, high = (found.select("_g", F.col("_rank").alias(k), F.col("_value").alias(v)) for k, v in (("_a", "_x"), ("_b", "_y")))
    both = pairs.join(low, ["_g", "_a"]).join(high, ["_g", "_b"])
    quantile = F.col("_x") + (F.col("_y") - F.col("_x")) * (F.col("at") - F.col("_a"))
    return both.select(F.col("_g").alias(group), "prob", quantile.alias("quantile"))
