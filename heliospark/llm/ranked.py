"""Ranked lexical search over all documents with k2-treaps.

1. Rows. The terms of a block of items are the rows of a grid. One pass over
   the texts writes for every document its length and its counts of those
   terms; N, L and the document frequencies are aggregates of that table.
2. Shards. Documents are dealt evenly, by row number, into shards of a bounded
   number of counts. In a shard they are columns, in order of their ids.
3. Tree. The cells (term, document) with an impact fill a quadtree whose empty
   cells are left out: a node holds a mask of its children, the place of the
   first, and the greatest impact below it.
4. Search. For an item a range of documents is bounded by the sum, over its
   terms, of the maxima of the nodes on the terms' row paths. All those paths
   descend together; the ranges of the highest bounds are opened first, many
   at a time, and a range is given up once ten documents score more than its
   bound. A range of one document is exact: its bound is its score.
5. A shard's ten best of each item meet in one ranking.

Everything is exact: the scores are integers and ties go by document id (NULL
ids first). Items travel to the tasks in blocks of bounded bytes, one search
over the stored rows for each block.

Defined cases: NULL or empty text has no term, such a document is never found
and such an item finds nothing; every row of docs is a document and every row
of items an item of its own, whatever its id; other columns are not needed;
empty tables give an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, stored

BEST = 10
ITEM_BYTES = 16 << 20  # of the items that are searched for together
SHARD_COUNTS = 1 << 20  # cells of the grid in a shard
FIRST, MOST = 64, 4096  # ranges opened at a time: doubled from FIRST up to MOST

# Bytes of terms as they are, letters lowered; all others are spaces.
_TERM = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
_TERM = _TERM.translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"))
_ONES = np.array([x.bit_count() for x in range(16)])


def terms(text: str | None) -> list[bytes]:
    """The terms of a text, repeats included."""
    return (text or "").encode().translate(_TERM).split()


def grid_rows(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, term, tf) of every (doc_id, text) with a term: its number of
    terms, and its counts of the vocabulary's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, n, found, counts = [], [], [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                own = terms(text)
                if own:
                    ids = np.fromiter(map(vocabulary.get, own, repeat(-1)), np.int32, len(own))
                    term, tf = np.unique(ids[ids >= 0], return_counts=True)
                    keep.append(i)
                    n.append(len(own))
                    found.append(term)
                    counts.append(tf)
            ends = pa.array(np.append(0, np.cumsum([len(t) for t in found])), pa.int32())
            lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate([*x, np.empty(0, np.int32)]).astype(t))) for x, t in ((found, np.int32), (counts, np.int64))]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep, pa.int32())), pa.array(n, pa.int64()), *lists], names=["doc_id", "n", "term", "tf"])

    return docs.mapInArrow(run, "doc_id long, n long, term array<int>, tf array<long>")


def frequencies(rows: DataFrame) -> DataFrame:
    """(term, df): documents that hold each term; one row a term and batch is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            term, df = np.unique(batch.column(0).flatten().to_numpy(), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(term, pa.int32()), pa.array(df, pa.int64())], names=["term", "df"])

    return rows.select("term").mapInArrow(run, "term int, df long").groupBy("term").agg(F.sum("df").alias("df"))


class Treap:
    """Compressed quadtree of (row, column, impact) cells with maxima."""

    def __init__(self, row: np.ndarray, column: np.ndarray, impact: np.ndarray) -> None:
        sides = (int(x.max()) if len(x) else 0 for x in (row, column))
        self.height = max(1, max(sides).bit_length())
        code = np.zeros(len(row), np.int64)
        for k in range(self.height):
            code |= (row >> k & 1) << 2 * k + 1 | (column >> k & 1) << 2 * k
        order = np.argsort(code)
        code, top = code[order], impact[order]
        # By level from the cells up; the last entry of each stands for an empty node.
        self.top = [np.append(top, 0)]
        self.first: list[np.ndarray] = [np.empty(0, np.int64)]
        self.mask: list[np.ndarray] = [np.empty(0, np.int64)]
        for _ in range(self.height):
            above = code >> 2
            at = np.flatnonzero(np.append(True, above[1:] != above[:-1])) if len(code) else np.empty(0, np.int64)
            child = 1 << (code & 3)
            self.first.append(np.append(at, 0))
            self.mask.append(np.append(np.bitwise_or.reduceat(child, at) if len(at) else at, 0))
            top = np.maximum.reduceat(top, at) if len(at) else top
            self.top.append(np.append(top, 0))
            code = above[at]

    def below(self, level: int, nodes: np.ndarray, child: np.ndarray) -> np.ndarray:
        """The nodes of the level below that are the given children of ``nodes``."""
        mask = self.mask[level][nodes]
        place = self.first[level][nodes] + _ONES[mask & (1 << child) - 1]
        return np.where(mask >> child & 1, place, len(self.top[level - 1]) - 1)

    def best(self, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(columns, scores) of the ``k`` columns with the greatest sums over ``rows``, ties by column."""
        rows = rows[rows < 1 << self.height]  # others have no cell here
        # Open ranges by level: bound, first column, and a node for each row path.
        open_ = {self.height: (np.array([len(rows) * int(self.top[-1][0])]), np.zeros(1, np.int64), np.zeros((1, len(rows)), np.int64))}
        columns, scores = np.empty(0, np.int64), np.empty(0, np.int64)
        least, many = 1, FIRST  # a score of 0 is no find
        while open_:
            bounds = np.concatenate([b for b, _, _ in open_.values()])
            edge = max(least, int(np.partition(bounds, len(bounds) - many)[len(bounds) - many])) if len(bounds) > many else least
            many = min(2 * many, MOST)
            made: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}
            for level, (bound, start, nodes) in open_.items():
                now, later = bound >= edge, (bound < edge) & (bound >= least)
                if later.any():
                    made.setdefault(level, []).append((bound[later], start[later], nodes[later]))
                if now.any():
                    at, start = nodes[now], start[now]
                    bit = (rows >> level - 1 & 1) * 2
                    for half in (0, 1):
                        new = self.below(level, at, bit + half)
                        total = self.top[level - 1][new].sum(1)
                        good = total >= least
                        made.setdefault(level - 1, []).append((total[good], start[good] + (half << level - 1), new[good]))
            for total, start, _ in made.pop(0, ()):
                columns, scores = np.append(columns, start), np.append(scores, total)
            if len(scores) >= k:
                order = np.lexsort((columns, -scores))[:k]
                columns, scores = columns[order], scores[order]
                least = max(least, int(scores[-1]))
            open_ = {level: tuple(np.concatenate(x) for x in zip(*parts, strict=True)) for level, parts in made.items()}
            open_ = {level: x for level, x in open_.items() if len(x[0])}
        order = np.lexsort((columns, -scores))
        return columns[order], scores[order]


def impacts(weight: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return weight * (1_000_000_000 * tf // (1000 * tf + 8 * m))


def _searched(rows: DataFrame, shards: int, wanted: list[np.ndarray], weight: np.ndarray, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """(item, doc_id, score): the ``k`` best documents of each item in each shard."""

    def run(shard: pa.Table) -> pa.Table:
        null = np.asarray(shard["doc_id"].is_null())
        ids = shard["doc_id"].fill_null(0).to_numpy()
        order = np.lexsort((ids, ~null))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        m = np.array([10 + 90 * n * n_docs // n_terms for n in shard["n"].to_pylist()], np.int64)
        lists = shard["term"].combine_chunks()
        owner = np.repeat(np.arange(len(ids)), lists.value_lengths().to_numpy())
        term, tf = lists.flatten().to_numpy().astype(np.int64), shard["tf"].combine_chunks().flatten().to_numpy()
        score = impacts(weight[term], tf, m[owner])
        some = score > 0
        tree = Treap(term[some], place[owner[some]], score[some])
        item, doc, total = [], [], []
        for i, own in enumerate(wanted):
            columns, scores = tree.best(own, k)
            item.append(np.full(len(columns), i))
            doc.append(order[columns])
            total.append(scores)
        at = pa.array(np.concatenate([*doc, np.empty(0, np.int64)]).astype(np.int64))
        return pa.table({"item": pa.array(np.concatenate([*item, np.empty(0)]).astype(np.int64)), "doc_id": shard["doc_id"].combine_chunks().take(at), "score": pa.array(np.concatenate([*total, np.empty(0)]).astype(np.int64))})

    # Every row has a number of its own, so no shard can be hot.
    dealt = rows.withColumn("_shard", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards)))
    return dealt.groupBy("_shard").applyInArrow(lambda t: run(t), "item long, doc_id long, score long")


def _ranked(docs: DataFrame, items: list[tuple[int | None, str | None]], k: int, shard_counts: int) -> DataFrame:
    """(item_id, rank, doc_id, score) for one block of items."""
    asked = [sorted(set(terms(text))) for _, text in items]
    vocabulary = {t: i for i, t in enumerate(sorted({t for own in asked for t in own}))}
    rows = stored(grid_rows(docs, vocabulary), "ranked_rows")
    n_docs, n_terms, counts = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(1)), F.coalesce(F.sum(F.size("term")), F.lit(0))).first()
    weight = np.zeros(len(vocabulary), np.int64)
    for r in frequencies(rows).collect():  # one row a term of the block
        weight[r["term"]] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * r["df"] + 1)))
    wanted = [np.array([vocabulary[t] for t in own], np.int64) for own in asked]
    found = _searched(rows, max(1, -(-counts // shard_counts)), wanted, weight, n_docs, n_terms, k)
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.asc_nulls_first("doc_id"))
    found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    names = docs.sparkSession.createDataFrame([(i, x) for i, (x, _) in enumerate(items)], "item long, item_id long")
    out = stored(found.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"), "ranked")
    discard(rows)
    return out


def ranked(docs: DataFrame, items: DataFrame, key: str = "doc_id", text_column: str = "text", item_key: str = "item_id", item_text: str = "text", k: int = BEST, item_bytes: int = ITEM_BYTES, shard_counts: int = SHARD_COUNTS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of every item."""
    docs = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    items = items.select(F.col(item_key).cast("long").alias("item_id"), F.col(item_text).alias("text"))
    held = items.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 64)).first()[0] or 0
    blocks = max(1, -(-held // item_bytes))
    parts = []
    for b in range(blocks):
        some = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b) if blocks > 1 else items
        parts.append(_ranked(docs, [(r["item_id"], r["text"]) for r in some.collect()], k, shard_counts))
    return reduce(DataFrame.unionByName, parts)


RANKED_SQL = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents),
lengths AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
totals AS (SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM lengths),
wanted AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
counts AS (SELECT doc_id, term, count(*) AS tf FROM words WHERE term IN (SELECT term FROM wanted) GROUP BY doc_id, term),
weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w
  FROM counts, totals GROUP BY term, docs),
impacts AS (
  SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // total))) AS impact
  FROM counts JOIN weights USING (term) JOIN lengths USING (doc_id), totals),
scores AS (SELECT item_id, doc_id, sum(impact)::BIGINT AS score FROM wanted JOIN impacts USING (term) GROUP BY item_id, doc_id),
ranks AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranks WHERE rank <= 10
"""
