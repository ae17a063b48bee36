"""Mixing sources to target weights by repeating documents.

The words of every source are summed, the sources share a total by weight (no
source above ``cap`` times its own words; what it cannot take is shared again
among the others), and a source's repetition rate is its target by its words.
A document is emitted floor(rate) times, and once more if a draw from the hash
of its id and text is below the fraction of the rate.

Sizes and draws are column expressions; texts are never shuffled. Only one row
a source is: its sum is combined before the shuffle, its place in the order
comes from the global index, and the common level of the shares is found by
rounds of one aggregate over the sources (each round caps the sources that
the level reaches; it only rises, so it ends).

Defined cases: NULL text has no words, an empty text none either, and both are
taken as often as any document of their source; NULL is a source of its own,
the last in order; a source without words has target 0; rows alike in id and
text draw alike; columns of docs named like the ones added are replaced; an
empty table gives an empty table.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.global_order import with_global_index
from .common import discard, stored, text_of

WEIGHTS = (5, 2, 1)  # of the sources in order, repeating
SHARE = (3, 2)  # of all words, as a fraction
CAP = 2  # of a source's words
WORD = r"[^\x20\x09-\x0D]+"
BROADCAST_BYTES = 32 << 20  # of the sources; beyond it they are joined by a shuffle
SALTS = 64  # tasks that share the documents of one source in that shuffle
ADDED = ("size", "source_size", "target", "copies")
_KEY = ("_mix_source", "_mix_null")


def words_in(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def _sized(docs: DataFrame, source: str, text_column: str) -> DataFrame:
    name = docs[source].cast("string")
    return docs.withColumns({"size": words_in(text_of(docs, text_column)), _KEY[0]: F.coalesce(name, F.lit("")), _KEY[1]: name.isNull()})


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: tuple[int, int] = SHARE, cap: int = CAP) -> DataFrame:
    """(source key, source_size, target) for the sources of sized documents."""
    sums = sized.groupBy(*_KEY).agg(F.sum("size").alias("source_size"))
    ranked = with_global_index(sums, [_KEY[1], _KEY[0]])
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod("gidx", F.lit(len(weights))) + 1).cast("int"))
    sources = stored(ranked.select(*_KEY, "source_size", weight.alias("weight")), "mix_sources")
    # In units of 1 / share[1] words: all that is shared, and what a source can take.
    most = cap * share[1] * F.col("source_size").cast("decimal(38,0)")
    words, heavy = sources.agg(F.sum(F.col("source_size").cast("decimal(38,0)")), F.sum("weight")).first()
    total, free = share[0] * (words or Decimal(0)), heavy or 0
    left, capped, before = total, F.lit(False), 0
    while free:
        # The level is left / free a unit of weight.
        capped = most * F.lit(Decimal(free)) <= F.lit(left) * F.col("weight")
        n, taken, heavy_capped = sources.where(capped).agg(F.count(F.lit(1)), F.sum(most), F.sum("weight")).first()
        if n == before:
            break
        before, left, free = n, total - (taken or 0), heavy - (heavy_capped or 0)
    level = F.lit(float(left)) * F.col("weight") / F.lit(float(free * share[1] or 1))
    target = F.when(capped, F.col("source_size").cast("double") * cap).otherwise(level) if free else F.col("source_size").cast("double") * cap
    return sources.select(*_KEY, "source_size", target.alias("target"))


def _draw(docs: DataFrame, key: str, text_column: str, seed: int) -> Column:
    """Uniform in [0, 1) by the hash of seed, id and text."""
    name = F.concat_ws(":", F.lit(str(seed)), F.coalesce(docs[key].cast("string"), F.lit("")), F.md5(text_of(docs, text_column)))
    return F.conv(F.substring(F.md5(name), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def mixed(docs: DataFrame, key: str = "doc_id", source: str = "source", text_column: str = "text", seed: int = 0, weights: tuple[int, ...] = WEIGHTS, share: tuple[int, int] = SHARE, cap: int = CAP, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``docs`` with its ``size``, its source's ``source_size`` and ``target``,
    and ``copies``, how often the mix takes it."""
    docs = docs.drop(*ADDED)
    sized = _sized(docs, source, text_column)
    targets = source_targets(sized.select("size", *_KEY), weights, share, cap)
    draw = _draw(docs, key, text_column, seed)
    held = targets.agg(F.sum(F.length(_KEY[0]) * 4 + 64)).first()[0] or 0
    if held <= broadcast_bytes:
        both = sized.withColumn("_mix_draw", draw).join(F.broadcast(targets), list(_KEY))
    else:
        salt = F.pmod(F.xxhash64("_mix_draw"), F.lit(SALTS))
        spread = targets.withColumn("_mix_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<long>")))
        both = sized.withColumn("_mix_draw", draw).withColumn("_mix_salt", salt).join(spread, [*_KEY, "_mix_salt"])
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    copies = F.floor(rate) + (F.col("_mix_draw") < rate - F.floor(rate)).cast("long")
    return both.select(*docs.columns, "size", "source_size", "target", copies.alias("copies"))


def emitted(mix: DataFrame) -> DataFrame:
    """The rows of the mix: every document ``copies`` times, with its ``copy`` number from 0."""
    return mix.drop("copy").where("copies > 0").withColumn("copy", F.explode(F.expr("sequence(0L, copies - 1)"))).drop("copies")


def mix_report(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target and the words taken of every document."""
    mix = mixed(docs.select("doc_id", "source", "text"))
    return mix.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, md5(coalesce(text, '')) AS digest,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5, 2, 1][1 + (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3]::BIGINT AS weight
  FROM sized GROUP BY source),
-- Sources by words per weight: the first ones reach their cap of 2 times their words.
running AS (
  SELECT *, sum(source_size) OVER ()::HUGEINT AS words, sum(weight) OVER ()::HUGEINT AS weights,
         coalesce(sum(source_size) OVER before, 0)::HUGEINT AS words_before,
         coalesce(sum(weight) OVER before, 0)::HUGEINT AS weight_before
  FROM sources
  WINDOW before AS (ORDER BY source_size * (10 // weight), source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
told AS (
  SELECT *, 4 * source_size::HUGEINT * (weights - weight_before) <= weight * (3 * words - 4 * words_before) AS capped FROM running),
level AS (
  SELECT 3 * coalesce(sum(source_size), 0)::HUGEINT - 4 * coalesce(sum(source_size) FILTER (capped), 0)::HUGEINT AS units,
         coalesce(sum(weight) FILTER (NOT capped), 0)::HUGEINT AS free FROM told),
targets AS (
  SELECT source, source_size,
         CASE WHEN capped THEN source_size::DOUBLE * 2 ELSE units::DOUBLE * weight / (free * 2)::DOUBLE END AS target
  FROM told, level),
rated AS (
  SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate,
         ('0x' || substr(md5('0:' || coalesce(doc_id::VARCHAR, '') || ':' || digest), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS draw
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source)
SELECT doc_id, size, source_size, target,
       ((floor(rate)::BIGINT + (draw < rate - floor(rate))::BIGINT) * size)::BIGINT AS taken
FROM rated
"""
