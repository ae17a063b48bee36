"""Removal of byte strings that repeat anywhere in the corpus, by suffix arrays.

1. Routing. Of the shorter windows inside every LENGTH-byte string the one of
   least hash (the leftmost) is its anchor; equal strings have equal
   anchors at the same place. A document falls into fragments: runs of strings
   with one anchor. Only fragments whose anchor occurs again can hold a repeat.
2. Collapse. Equal fragments of an anchor are counted; those seen twice are
   repeats as a whole and need no sorting. One of each stays as evidence.
3. Shards. The different fragments of an anchor go to one shard. It leaves out
   ranges of strings whose core no other fragment of the anchor has, sorts the
   other suffixes by Larsson-Sadakane refinement in numpy (only groups that are
   still tied are sorted again, by the ranks twice as far on), finds the common
   prefixes of neighbours by Kasai's method, run over the strings of all
   fragments in step, and marks those whose common prefix reaches LENGTH.
4. Merging across shards. The fragments of an anchor may be too many for one
   shard (a passage in every other document). They are merged by binary
   search for the place of a match: the range of string starts is halved, a
   half's strings share a core that all of them contain, and only fragments
   with equal cores meet again; equal parts collapse as in 2, and halving goes
   on until a class fits a shard. No text meets all others of its class.

Everything is exact but for 64-bit hashes of fragments within an anchor.

Defined cases: NULL text is empty; a text shorter than LENGTH bytes loses
nothing; every row is a document of its own whatever its id, so repeated rows
are occurrences of each other; other columns pass through, but for those named
like the ones added; an empty table gives an empty table. Blocks of a long
text overlap, with the same result.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shared_path
from .common import discard, stored, text_of

LENGTH = 400
BLOCK = 1 << 20  # bytes worked on together
CLASS_FRAGMENTS = 2000  # of one class in a shard; a larger class is halved
SHARD_BYTES = 1 << 20  # a task's arrays take some 150 bytes for each of them
RANGE = 32  # strings of a fragment that a shard keeps or leaves out together
BUCKET_BYTES = 64 << 20  # of texts in a bucket of the table that the runs are brought to

_B = 0x9E3779B97F4A7C15


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def gram_of(length: int) -> int:
    """The bytes of an anchor for strings of a length: a power of two, a third
    of the length at most; strings of one class share at least so many."""
    return 1 << (max(1, length // 3)).bit_length() - 1


def gram_hashes(x: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the ``gram`` bytes from each position on."""
    h = x.astype(np.uint64) + np.uint64(1)
    span = 1
    while span < gram:
        h = h[:-span] * np.uint64(pow(_B, span, 1 << 64)) + h[span:]
        span *= 2
    return _mixed(h)


def anchors(x: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, anchor position, first string, strings) of each fragment of
    a text of at least ``length`` bytes."""
    hashes, places = [], []
    n, gram = len(x) - length + 1, gram_of(length)
    window = length - gram + 1
    for lo in range(0, n, BLOCK):
        h = gram_hashes(x[lo : lo + BLOCK + length - 1], gram)
        # Least hash, then leftmost place: the low bits of the hash make room for the place.
        key = h & ~np.uint64((1 << 22) - 1) | np.arange(len(h), dtype=np.uint64)
        span = 1
        while span < window:
            step = min(span, window - span)
            key = np.minimum(key[:-step], key[step:])
            span += step
        place = (key & np.uint64((1 << 22) - 1)).astype(np.int64)
        hashes.append(h[place])
        places.append(place + lo)
    place, h = np.concatenate(places), np.concatenate(hashes)
    first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
    return h[first].view(np.int64), place[first], first, np.diff(np.append(first, n))


def fragments(texts: DataFrame, length: int) -> DataFrame:
    """(anchor, fragment, row, places, n, ahead): every fragment of every
    (row, text). It has n strings, the first of which is ``ahead`` bytes ahead
    of the anchor and starts at each of ``places`` in the text (a text that
    repeats itself has one row with many places, not many rows)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list[np.ndarray]] = []
            starts: list[np.ndarray] = []
            for row, text in zip(*(batch.column(k).to_pylist() for k in range(2)), strict=True):
                data = text.encode()
                if len(data) < length:
                    continue
                a, at, lo, n = anchors(np.frombuffer(data, np.uint8), length)
                digest = xxhash.xxh3_64_intdigest
                ends = (lo + n + length - 1).tolist()
                seeds = (at - lo).tolist()
                own = np.fromiter((digest(data[i:j], s) for i, j, s in zip(lo.tolist(), ends, seeds, strict=True)), np.uint64, len(lo))
                by = np.lexsort((lo, own, a))
                a, own, lo, n, ahead = a[by], own.view(np.int64)[by], lo[by], n[by], (at - lo)[by]
                first = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (own[1:] != own[:-1])))
                k = len(first)
                out.append([a[first], own[first], np.full(k, row), n[first], ahead[first], np.diff(np.append(first, len(a)))])
                starts.append(lo)
            if out:
                a, own, row, n, ahead, count = (np.concatenate(c) for c in zip(*out, strict=True))
                ends = np.append(0, np.cumsum(count)).astype(np.int32)
                places = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(starts).astype(np.int32)))
                made = [pa.array(c.astype(np.int64)) for c in (a, own, row)] + [places] + [pa.array(c.astype(np.int32)) for c in (n, ahead)]
                yield pa.RecordBatch.from_arrays(made, names=["anchor", "fragment", "row", "places", "n", "ahead"])

    return texts.mapInArrow(run, "anchor long, fragment long, row long, places array<int>, n int, ahead int")


def _sevens(x: np.ndarray) -> np.ndarray:
    """The 7 symbols of 9 bits from each position on as one number."""
    n = len(x)
    padded = np.append(x.astype(np.uint64), np.zeros(8, np.uint64))
    out = np.zeros(n, np.uint64)
    for k in range(7):
        out = out << np.uint64(9) | padded[k : k + n]
    return out


def suffix_order(x: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array of ``x`` by the first ``reach`` symbols (0 ends a fragment),
    and the group number of each suffix (equal where those symbols are equal).

    Larsson-Sadakane: suffixes are sorted by their first 8 symbols; then the
    groups that are still tied are sorted by the groups of the suffixes as far
    on as the order already reaches, which doubles it.
    """
    n = len(x)
    first = _sevens(x)
    order = np.argsort(first)
    starts = np.append(True, first[order][1:] != first[order][:-1])
    group = np.empty(n + 1, np.int64)
    group[order] = np.flatnonzero(starts)[np.cumsum(starts) - 1]  # a group's number is the place of its first
    group[n] = -1
    done = 7
    while done < reach:
        ahead = min(done, reach - done)
        size = np.diff(np.append(np.flatnonzero(starts), n))
        tied = np.repeat(size > 1, size)
        place = np.flatnonzero(tied)
        if not len(place):
            break
        some = order[place]
        own, then = group[some], group[np.minimum(some + ahead, n)]
        by = np.argsort(own * (n + 2) + then + 1)
        some, own, then = some[by], own[by], then[by]
        order[place] = some
        new = np.append(True, (own[1:] != own[:-1]) | (then[1:] != then[:-1]))
        starts[place] = new
        group[some] = place[new][np.cumsum(new) - 1]
        done += ahead
    return order, group[:n]


def common_prefixes(x: np.ndarray, order: np.ndarray, group: np.ndarray, begins: np.ndarray, ends: np.ndarray, reach: int) -> np.ndarray:
    """For each suffix the length of the prefix it shares with the one before
    it in the order, up to ``reach``.

    Suffixes of one group share ``reach``. With the last suffix of the group
    before, which is strictly smaller, Kasai's rule holds: from one suffix of a
    text to the next the length falls by one at most. The suffixes from begin to
    end of all fragments go in step; others have 0.
    """
    n = len(x)
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    out = np.zeros(n, np.int32)
    padded = np.append(x, np.zeros(reach + 1, x.dtype))
    sevens = np.append(_sevens(x), np.zeros(reach + 1, np.uint64))
    at, known = begins.copy(), np.zeros(len(begins), np.int64)
    going = np.flatnonzero(begins < ends)
    while len(going):
        i = at[going]
        head = group[i]
        j = order[np.maximum(head - 1, 0)]
        length = np.where(head > 0, known[going], 0)
        # By seven symbols, then by one.
        for step, symbols in ((7, sevens), (1, padded)):
            grow = np.flatnonzero(head > 0)
            while len(grow):
                a, b, k = i[grow], j[grow], length[grow]
                same = (k + step <= reach) & (np.maximum(a, b) + k + step <= n) & (symbols[a + k] == symbols[b + k])
                grow = grow[same]
                length[grow] += step
        out[i] = np.where(place[i] > head, reach, length)
        known[going] = np.maximum(length - 1, 0)
        at[going] = i + 1
        going = going[at[going] < ends[going]]
    return out


def repeated_strings(pieces: list[bytes], length: int = LENGTH) -> list[np.ndarray]:
    """For each piece the starts of its ``length``-byte strings that occur again in these pieces."""
    lengths = np.array([len(p) for p in pieces], np.int64)
    x = np.frombuffer(b"\0".join(pieces) + b"\0", np.uint8).astype(np.uint16) + 1
    ends = np.cumsum(lengths + 1) - 1
    x[ends] = 0
    begins = ends - lengths
    order, group = suffix_order(x, length)
    # A suffix shorter than a string shares none.
    shared = common_prefixes(x, order, group, begins, ends - length + 1, length)
    place = np.empty(len(x), np.int64)
    place[order] = np.arange(len(x))
    # A string repeats if the suffix before or after it in the order shares all of it.
    long = shared[order] >= length
    again = (long | np.append(long[1:], False))[place]
    return [np.flatnonzero(again[b : max(b, e - length + 1)]) for b, e in zip(begins, ends, strict=True)]


def _runs(starts: np.ndarray) -> list[tuple[int, int]]:
    """Half-open runs of consecutive numbers."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > 1)
    return list(zip(starts[np.append(0, cut + 1)].tolist(), (starts[np.append(cut, len(starts) - 1)] + 1).tolist(), strict=True))


def _ranges(ahead: int, n: int, width: int) -> Iterator[tuple[int, int, int]]:
    """(low, at, to): the strings [at, to) of a fragment are low to
    low + width - 1 bytes ahead of the anchor."""
    at = 0
    while at < n:
        low = (ahead - at) // width * width
        to = min(n, ahead - low + 1)
        yield low, at, to
        at = to


def _core(data: bytes, ahead: int, low: int, width: int, length: int) -> bytes:
    """What all strings of a range have in common."""
    return data[ahead - low : ahead - (low + width - 1) + length]


def shared_ranges(classes: list[int], aheads: list[int], counts: list[int], datas: list[bytes], length: int) -> list[tuple[int, int, int]]:
    """(piece, at, to): the strings of each piece in ranges whose core another
    piece of its class has too. No other string can be in another piece."""
    digest, width = xxhash.xxh3_64_intdigest, min(RANGE, length)
    cores: list[list[tuple]] = []
    seen: Counter = Counter()
    for cls, ahead, n, data in zip(classes, aheads, counts, datas, strict=True):
        cores.append([(cls, low, digest(_core(data, ahead, low, width, length))) for low, _, _ in _ranges(ahead, n, width)])
        seen.update(cores[-1])
    out = []
    for i, (ahead, n) in enumerate(zip(aheads, counts, strict=True)):
        last = -1
        for (_, at, to), core in zip(_ranges(ahead, n, width), cores[i], strict=True):
            if seen[core] > 1:
                if at == last:
                    out[-1] = (i, out[-1][1], to)
                else:
                    out.append((i, at, to))
                last = to
    return out


def _in_shards(pieces: DataFrame, length: int) -> DataFrame:
    """(class, fragment, a, b): runs of repeated strings, classes whole in a shard."""
    total = pieces.agg(F.sum(F.length("data"))).first()[0] or 0
    shards = max(1, -(-int(total) // SHARD_BYTES))

    def run(rows: pa.Table) -> pa.Table:
        classes, frags, aheads, counts, datas = (rows[k].to_pylist() for k in ("class", "fragment", "ahead", "n", "data"))
        some = shared_ranges(classes, aheads, counts, datas, length)
        found = repeated_strings([datas[i][at : to + length - 1] for i, at, to in some], length) if some else []
        c, f, a, b = [], [], [], []
        for (k, at, _), starts in zip(some, found, strict=True):
            for i, j in _runs(starts + at):
                c.append(classes[k])
                f.append(frags[k])
                a.append(i)
                b.append(j)
        return pa.table([pa.array(c, pa.int64()), pa.array(f, pa.int64()), pa.array(a, pa.int32()), pa.array(b, pa.int32())], names=["class", "fragment", "a", "b"])

    dealt = pieces.select("class", "fragment", "ahead", "n", "data").withColumn("_shard", F.pmod(F.xxhash64("class"), F.lit(shards)))
    return dealt.groupBy("_shard").applyInArrow(lambda t: run(t), "class long, fragment long, a int, b int")


def _halved(pieces: DataFrame, width: int, length: int) -> DataFrame:
    """Pieces cut at multiples of ``width`` string starts (counted from the
    anchor): (class, fragment, sub, part, shift, ahead, n, data), where ``sub``
    is the hash of the core that the strings of that range have in common."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        names = ["class", "fragment", "sub", "part", "shift", "ahead", "n", "data"]
        types = [pa.int64()] * 4 + [pa.int32()] * 3 + [pa.binary()]
        for batch in batches:
            out = []
            for cls, frag, ahead, n, data in zip(*(batch.column(c).to_pylist() for c in ("class", "fragment", "ahead", "n", "data")), strict=True):
                for low, at, to in _ranges(ahead, n, width):
                    part = data[at : to + length - 1]
                    sub = digest(_core(data, ahead, low, width, length), (cls ^ low * 0x9E3779B9) & (1 << 64) - 1)
                    out.append((cls, frag, np.int64(np.uint64(sub)), np.int64(np.uint64(digest(part, ahead - at))), at, ahead - at, to - at, part))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [[]] * 8, types, strict=True)], names=names)

    return pieces.select("class", "fragment", "ahead", "n", "data").mapInArrow(run, "class long, fragment long, sub long, part long, shift int, ahead int, n int, data binary")


def repeated_runs(pieces: DataFrame, length: int, used: list[DataFrame], width: int = 0) -> DataFrame:
    """(class, fragment, a, b) over the different pieces (class, fragment,
    ahead, n, data) of each class: runs of strings that occur in another. The
    tables that the result is read from are added to ``used``."""
    # A range of string starts, at first a power of two of those of an anchor.
    width = width or 1 << (length - gram_of(length) + 1).bit_length() - 1
    pieces = stored(pieces, "repeat_pieces")
    used.append(pieces)
    sizes = pieces.groupBy("class").agg(F.count(F.lit(1)).alias("_v"))
    large = stored(sizes.where(F.col("_v") > CLASS_FRAGMENTS).select("class"), "repeat_large")
    if not large.take(1):
        return _in_shards(pieces, length)
    found = _in_shards(pieces.join(large, "class", "left_anti"), length)
    parts = stored(_halved(pieces.join(large, "class"), width, length), "repeat_parts")
    same = parts.groupBy("sub", "part").agg(F.count(F.lit(1)).alias("c"), F.first("data").alias("data"), F.first("ahead").alias("ahead"), F.first("n").alias("n"))
    same = stored(same, "repeat_same")
    used += [large, parts, same]
    whole = same.where("c > 1").select("sub", "part", F.lit(0).alias("a"), F.col("n").alias("b"))
    several = same.groupBy("sub").agg(F.count(F.lit(1)).alias("_v")).where("_v > 1").select("sub")
    rest = same.join(several, "sub").select(F.col("sub").alias("class"), F.col("part").alias("fragment"), "ahead", "n", "data")
    below = whole.unionByName(repeated_runs(rest, length, used, width // 2).withColumnsRenamed({"class": "sub", "fragment": "part"})) if width > 1 else whole
    return found.unionByName(parts.join(below, ["sub", "part"]).select("class", "fragment", (F.col("a") + F.col("shift")).alias("a"), (F.col("b") + F.col("shift")).alias("b")))


def bucketed(docs: DataFrame, text_column: str) -> DataFrame:
    """``docs`` as a table of (row, text, rest) in buckets by ``row``, a number
    of each row: texts are shuffled once, here, and every later join brings
    the other side to their bucket. No key of docs decides where a row goes."""
    spark = docs.sparkSession
    text = text_of(docs, text_column)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), text.alias("text"), F.struct(*[c for c in docs.columns if c != text_column]).alias("rest"))
    size = docs.agg(F.sum(F.octet_length(text_column))).first()[0] or 0
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))
    path = shared_path(spark, "repeat_texts")
    name = f"repeat_texts_{path[-12:]}"
    rows.repartition(n, "row").write.bucketBy(n, "row").option("path", path).saveAsTable(name)
    return spark.table(name)


def repeats(texts: DataFrame, length: int = LENGTH) -> DataFrame:
    """(row, runs) of the (row, text) rows with repeated strings: runs of their
    starts, as array<struct<places, a, b>>: [p + a, p + b) for each place p."""
    first = stored(fragments(texts.select("row", "text"), length), "fragments")
    again = first.groupBy("anchor").agg(F.sum(F.size("places")).alias("_c")).where("_c > 1").select("anchor")
    every = stored(first.join(again, "anchor"), "repeat_fragments")
    discard(first)
    # Of equal fragments one place stands for all.
    same = every.groupBy("anchor", "fragment").agg(F.sum(F.size("places")).alias("c"), F.min(F.struct("row", F.col("places")[0].alias("lo"), "n", "ahead")).alias("at"))
    same = stored(same, "repeat_variants")
    whole = same.where("c > 1").select("anchor", "fragment", F.lit(0).alias("a"), F.col("at.n").alias("b"))
    # Only a fragment seen once, beside others of its anchor, is still open.
    several = same.groupBy("anchor").agg(F.count(F.lit(1)).alias("_v"), F.min("c").alias("_c")).where("_v > 1 AND _c = 1").select("anchor")
    fetch = same.join(several, "anchor").groupBy("at.row").agg(F.collect_list(F.struct("anchor", "fragment", "at.lo", "at.n", "at.ahead")).alias("wanted"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, wanted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                data = text.encode()
                rows += [(w["anchor"], w["fragment"], w["ahead"], w["n"], data[w["lo"] : w["lo"] + w["n"] + length - 1]) for w in wanted]
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=["class", "fragment", "ahead", "n", "data"])

    pieces = texts.join(fetch.hint("shuffle_hash"), "row").select("text", "wanted").mapInArrow(cut, "class long, fragment long, ahead int, n int, data binary")
    used = [same]
    sorted_ = repeated_runs(pieces, length, used).withColumnRenamed("class", "anchor")
    # Fragments seen twice are whole already; of the others the runs that shards found.
    marked = whole.unionByName(sorted_.join(whole.select("anchor", "fragment"), ["anchor", "fragment"], "left_anti"))
    marked = stored(marked, "repeat_marked")
    for table in used:
        discard(table)
    return every.join(marked, ["anchor", "fragment"]).groupBy("row").agg(F.collect_list(F.struct("places", "a", "b")).alias("runs"))


def cleaned(docs: DataFrame, text_column: str = "text", length: int = LENGTH, as_text: bool = False) -> DataFrame:
    """``docs`` with the text replaced by ``kept`` (its remaining bytes, or the
    text they make without characters that a cut has split) and with
    ``n_bytes``, ``n_removed``, ``n_spans``."""
    from pyspark.sql import types as T

    names = ("kept", "n_bytes", "n_removed", "n_spans")
    texts = bucketed(docs.drop(*names), text_column)
    both = texts.join(repeats(texts, length).hint("shuffle_hash"), "row", "left").select("rest", "text", "runs")
    schema = T.StructType([T.StructField("rest", both.schema["rest"].dataType)] + [T.StructField("kept", T.StringType() if as_text else T.BinaryType())] + [T.StructField(c, T.LongType()) for c in names[1:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, counts = [], []
            for text, runs in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                data = text.encode()
                spans: list[list[int]] = []
                for a, b in sorted((p + r["a"], p + r["b"] + length - 1) for r in runs or () for p in r["places"]):
                    if spans and a <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], b)
                    else:
                        spans.append([a, b])
                edges = [0, *(e for s in spans for e in s), len(data)]
                kept.append(b"".join(data[i:j] for i, j in zip(edges[::2], edges[1::2], strict=True)))
                counts.append((len(data), len(data) - len(kept[-1]), len(spans)))
            made = pa.array([k.decode("utf-8", "ignore") for k in kept], pa.string()) if as_text else pa.array(kept, pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), made, *(pa.array(c, pa.int64()) for c in zip(*counts, strict=True))], names=schema.names)

    return both.mapInArrow(run, schema).select("rest.*", *names)


def repeats_report(docs: DataFrame) -> DataFrame:
    """Per document: bytes, removed bytes, removed runs, digest of the rest, and
    whether anything was removed."""
    found = cleaned(docs.select("doc_id", "text"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), (F.col("n_removed") > 0).alias("has_repeat"))


def without_repeats(docs: DataFrame, text_column: str = "text", length: int = LENGTH) -> DataFrame:
    """``docs`` with strings of ``length`` bytes that repeat cut out of the text;
    a character that a cut has split goes as well."""
    names = [F.col("kept").alias(c) if c == text_column else F.col(c) for c in docs.columns]
    return cleaned(docs, text_column, length, as_text=True).select(*names)
