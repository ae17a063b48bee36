"""Near-duplicate documents by weighted MinHash over bags of word shingles.

Every text is the bag of its five-word shingles. Its signature is a BagMinHash:
each shingle runs Poisson processes over a dyadic discretisation of its weight
(one of rate 1 on (0, 1], one on (1, 2], (2, 4], ...; a process that the weight
cuts keeps the points whose place, found by halving the interval, lies below
the weight), each point falls on a register, and a register keeps its first
point. Two registers agree with the probability of the weighted Jaccard
similarity. Bands of registers propose candidates; every link is verified by
the exact overlap of the two bags.

Groups are never expanded into pairs. Equal texts are one node. The members of
a bucket are compared with its least node, and where that leaves several
classes in a bucket, with the best partners in a block of it. Where that leaves
several classes, the blocks of a bucket meet two by two: whole signatures tell
who looks like a member of another class, and those members meet again with
their bags, in one task that compares every such pair and hands on the links
that join classes.

Defined cases: NULL text is empty; a text of fewer than five words is one
shingle, an empty text none (all empty texts are one class); repeated rows are
one class and one of them stays; other columns pass through; an empty table
gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import component_labels, stored, text_of

WORDS = 5
LEAST = 0.8
BANDS, ROWS = 32, 6
REGISTERS = BANDS * ROWS
# Registers that agree, of REGISTERS, for a pair to be verified: five standard
# deviations below what a similarity of LEAST gives, so that this loses less
# than the bands do.
LOOKS_ALIKE = int(REGISTERS * LEAST - 5 * (REGISTERS * LEAST * (1 - LEAST)) ** 0.5)
BROADCAST_ROWS = 500_000  # of 40 bytes
TASK_PARTNERS = 2000  # members compared with one node in a task
QUICK = 2  # partners of its block that a member meets before all others
BLOCK = 512  # members of a bucket compared at once
PAIRS = 256  # bags compared with one at once
SIGNED_ROWS, SIGNED_BYTES = 1024, 1 << 20  # of texts signed at once; their arrays take many times that
KNOWN_WORDS = 300_000  # hashes remembered by a worker; emptied when full

NO_KEY = -(1 << 63)  # stands for a NULL key

_WORDS: dict[str, int] = {}


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_hashes(text: str) -> np.ndarray:
    """64-bit hashes of the shingles of a text, repeats included."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    known = _WORDS
    if len(known) > KNOWN_WORDS:
        known.clear()
    for w in set(words).difference(known):
        known[w] = xxhash.xxh3_64_intdigest(w)
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    n = max(1, len(h) - WORDS + 1)
    out = np.zeros(n, np.uint64)
    for k in range(min(WORDS, len(h))):
        out = _mixed(out + h[k : k + n] + np.uint64(k + 1))
    return out


def bags(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, shingle hash, weight) of every distinct shingle, in order."""
    each = [shingle_hashes(t) for t in texts]
    owner = np.repeat(np.arange(len(each)), [len(e) for e in each])
    h = np.concatenate([*each, np.empty(0, np.uint64)])
    order = np.lexsort((h, owner))
    owner, h = owner[order], h[order]
    first = np.ones(len(h), bool)
    first[1:] = (owner[1:] != owner[:-1]) | (h[1:] != h[:-1])
    at = np.flatnonzero(first)
    return owner[at], h[at], np.diff(np.append(at, len(h)))


def signatures(owner: np.ndarray, h: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """(n, REGISTERS) signatures of n bags; a bag without shingles has zeros."""
    low = np.full((n, REGISTERS), np.inf)
    # A process for (0, 1] and for each (2^k, 2^(k+1)] that the weight reaches into.
    levels = np.where(weight > 1, np.ceil(np.log2(weight)).astype(np.int64), 0) + 1
    owner, h, weight = (np.repeat(x, levels) for x in (owner, h, weight))
    level = np.arange(len(h)) - np.repeat(np.cumsum(levels) - levels, levels)
    base = np.where(level > 0, 1 << np.maximum(level - 1, 0), 0)
    width = np.maximum(base, 1)
    seed = _mixed(h + level.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    x = np.zeros(len(h))
    step = 0
    while len(h):
        step += 1
        a = _mixed(seed + np.uint64(2 * step))
        b = _mixed(seed + np.uint64(2 * step + 1))
        x = x - np.log(((a >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / width
        place = base + ((b >> np.uint64(32)) * width.astype(np.uint64) >> np.uint64(32)).astype(np.int64)
        register = ((b & np.uint64(0xFFFFFFFF)) * np.uint64(REGISTERS) >> np.uint64(32)).astype(np.int64)
        inside = place < weight
        np.minimum.at(low.reshape(-1), owner[inside] * REGISTERS + register[inside], x[inside])
        live = np.unique(owner)
        last = np.zeros(n)
        last[live] = low[live].max(1)
        go = x <= last[owner]
        owner, h, weight, base, width, seed, x = (v[go] for v in (owner, h, weight, base, width, seed, x))
    out = _mixed(low.view(np.uint64)) >> np.uint64(32)
    out[np.isinf(low[:, 0])] = 0
    return out.astype(np.uint32)


def band_keys(signature: np.ndarray) -> np.ndarray:
    """(n, BANDS) 64-bit keys."""
    out = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), (len(signature), BANDS)).copy()
    parts = signature.reshape(len(signature), BANDS, ROWS)
    for k in range(ROWS):
        out = _mixed(out * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, k])
    return out.view(np.int64)


def text_slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """The rows in order, SIGNED_ROWS or SIGNED_BYTES of text at a time at most (one longer text by itself)."""
    ends = np.cumsum(np.append(0, pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False)), dtype=np.int64)
    lo = 0
    while lo < batch.num_rows:
        fit = int(np.searchsorted(ends, ends[lo] + SIGNED_BYTES, "right")) - 1
        hi = max(lo + 1, min(lo + SIGNED_ROWS, fit))
        yield batch.slice(lo, hi - lo)
        lo = hi


def signed(texts: DataFrame) -> DataFrame:
    """(key, digest, signature, total) of (key, digest, text); total is the bag's weight."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, 2):
                all_texts = part.column(2).to_pylist()
                owner, h, weight = bags(all_texts)
                sig = signatures(owner, h, weight, len(all_texts))
                full = np.zeros(len(all_texts), bool)
                full[owner] = True
                rows = [s.tobytes() if f else b"" for s, f in zip(sig, full, strict=True)]
                total = np.bincount(owner, weight, len(all_texts)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(rows, pa.binary()), pa.array(total)], names=["key", "digest", "signature", "total"])

    return texts.mapInArrow(run, "key long, digest binary, signature binary, total long")


def _buckets(nodes: DataFrame) -> DataFrame:
    """(bucket, node) of the bands of (node, signature)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some = [i for i, s in enumerate(batch.column(1).to_pylist()) if s]
            ids = batch.column(0).to_numpy()[some]
            raw = b"".join(s for s in batch.column(1).to_pylist() if s)
            keys = band_keys(np.frombuffer(raw, np.uint32).reshape(len(some), REGISTERS))
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(np.repeat(ids, BANDS))], names=["bucket", "node"])

    return nodes.select("node", "signature").mapInArrow(run, "bucket long, node long")


def _agreeing(pairs: DataFrame, nodes: DataFrame, least: float) -> DataFrame:
    """Of (a, b) pairs those whose signatures agree in LOOKS_ALIKE registers."""
    sig = nodes.select("node", "signature", "total")
    both = pairs.join(sig.select(F.col("node").alias("a"), F.col("signature").alias("x"), F.col("total").alias("s")), "a").join(sig.select(F.col("node").alias("b"), F.col("signature").alias("y"), F.col("total").alias("t")), "b")
    both = both.where(F.least("s", "t") >= least * F.greatest("s", "t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(-1, REGISTERS) for c in (2, 3))
            keep = pa.array((x == y).sum(1) >= LOOKS_ALIKE)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])

    return both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


class _Links:
    """Classes of the links so far, the pairs already compared, the bags at hand."""

    def __init__(self, nodes: DataFrame, docs: DataFrame, least: float) -> None:
        self.nodes, self.docs, self.least = nodes, docs, least
        self.stars: DataFrame | None = None  # (node, component) of the links so far
        self.tested: DataFrame | None = None
        self.bags: DataFrame | None = None

    def hold(self, wanted: DataFrame) -> None:
        """Compute the bags of the given nodes that have none yet."""
        wanted = wanted.select("node").distinct()
        if self.bags is not None:
            wanted = wanted.join(self.bags.select("node"), "node", "left_anti")
        wanted = stored(self.nodes.select("node", "key", "digest").join(wanted, "node"), "near_wanted")
        n = wanted.count()
        if not n:
            return
        # A few rows are broadcast; else both sides are shuffled.
        texts = self.docs.join(F.broadcast(wanted) if n <= BROADCAST_ROWS else wanted, ["key", "digest"]).select("node", "text").dropDuplicates(["node"])

        def bag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                made = []
                for t in batch.column(1).to_pylist():
                    _, h, w = bags([t or ""])
                    made.append(h.tobytes() + w.astype(np.uint32).tobytes())
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], names=["node", "bag"])

        more = stored(texts.mapInArrow(bag, "node long, bag binary"), "near_bags")
        self.bags = more if self.bags is None else self.bags.unionByName(more)

    def link(self, found: DataFrame) -> DataFrame:
        """Take in (a, b) links and return the (node, component) rows."""
        if self.stars is not None:  # old links count as the stars they have made
            found = found.unionByName(self.stars.select(F.col("node").alias("a"), F.col("component").alias("b")))
        self.stars = component_labels(found, "near_classes")
        return self.stars

    def compare(self, pairs: DataFrame) -> DataFrame:
        """Verify (a, b) pairs, few for each b, by the exact overlap of their
        bags and return the new (node, component) rows. The bag of b goes to
        the tasks of a, where the bag of a waits, one copy for each task."""
        if self.tested is not None:
            pairs = pairs.join(self.tested, ["a", "b"], "left_anti")
        pairs = stored(pairs.select("a", "b").distinct(), "near_pairs")
        self.hold(pairs.select(F.explode(F.array("a", "b")).alias("node")))
        self.tested = pairs if self.tested is None else self.tested.unionByName(pairs)
        if self.bags is None:
            return self.link(pairs)
        # Only nodes with many partners need several tasks.
        many = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / TASK_PARTNERS).cast("int").alias("salts")).where("salts > 1")
        own = pairs.select("a").distinct().join(many, "a", "left").select("a", F.coalesce("salts", F.lit(1)).alias("salts"))
        centre = own.join(self.bags, F.col("a") == F.col("node")).select("a", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(None).cast("long").alias("b"), "bag")
        member = pairs.join(many, "a", "left").join(self.bags, F.col("b") == F.col("node")).select("a", F.pmod(F.xxhash64("b"), F.coalesce("salts", F.lit(1))).cast("int").alias("salt"), "b", "bag")
        meeting = centre.unionByName(member).repartition("a", "salt").sortWithinPartitions("a", "salt", F.asc_nulls_first("b"))
        return self.link(stored(meeting.mapInArrow(_overlapping(self.least), "a long, b long"), "near_links"))

    def compare_all(self, dealt: DataFrame) -> DataFrame:
        """Verify every look-alike pair of bucket mates of different classes and
        return the new (node, component) rows.

        The blocks of a bucket meet two by two. First they meet with signatures,
        which tells the members that look like one of another class; only those
        then meet again, with their bags, and a task hands on no more links than
        join its classes. A pair is never a row."""
        alike = stored(_met(dealt, self.nodes, _look_alikes(self.least), "bucket long, p int, q int, block int, node long, class long"), "near_alike")
        self.hold(alike)
        if self.bags is None:
            return self.link(alike.select(F.col("node").alias("a"), F.col("node").alias("b")))
        nodes = self.nodes.select("node", "signature", "total").join(self.bags, "node")
        found = stored(_met(alike, nodes, _linked(self.least), "a long, b long"), "near_found")
        # What has been compared, for audits; not computed otherwise.
        self.tested = self.tested.unionByName(_met(alike, nodes, _linked(self.least, audit=True), "a long, b long"))
        return self.link(found)


def _parsed(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(data) // 12
    return np.frombuffer(data, np.uint64, n), np.frombuffer(data, np.uint32, n, 8 * n)


def _overlapping(least: float):
    def overlap(x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray]) -> float:
        at = np.searchsorted(x[0], y[0])
        at[at == len(x[0])] = 0
        same = x[0][at] == y[0]
        shared = int(np.minimum(x[1][at], y[1])[same].sum(dtype=np.int64))
        return shared / (int(x[1].sum(dtype=np.int64)) + int(y[1].sum(dtype=np.int64)) - shared)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None
        for batch in batches:
            found = []
            for a, b, data in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "bag")), strict=True):
                if b is None:
                    own = _parsed(data)
                elif overlap(own, _parsed(data)) >= least:
                    found.append((a, b))
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in found], pa.int64()), pa.array([b for _, b in found], pa.int64())], names=["a", "b"])

    return run


def _dealt(open_: DataFrame) -> DataFrame:
    """(bucket, node, class, blocks, block): the members of each bucket in blocks."""
    sizes = open_.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    return open_.join(sizes, "bucket").select("bucket", "node", "class", "blocks", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block"))


def _quick(dealt: DataFrame, nodes: DataFrame, least: float) -> DataFrame:
    """(a, b): for the members of a block outside its largest class the QUICK
    members of other classes that look most alike."""
    sent = dealt.join(nodes.select("node", "signature", "total"), "node").select("bucket", "block", "node", "class", "signature", "total")

    def compare(rows: pa.Table) -> pa.Table:
        sig = np.frombuffer(b"".join(rows["signature"].to_pylist()), np.uint32).reshape(-1, REGISTERS)
        node, cls, total = (rows[c].to_numpy() for c in ("node", "class", "total"))
        names, counts = np.unique(cls, return_counts=True)
        a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for i in np.flatnonzero(cls != names[counts.argmax()]):
            # Bags whose weights differ too much cannot overlap enough.
            others = np.flatnonzero((cls != cls[i]) & (np.minimum(total, total[i]) >= least * np.maximum(total, total[i])))
            agree = (sig[others] == sig[i]).sum(1)
            good = np.flatnonzero(agree >= LOOKS_ALIKE)
            best = node[others[good[np.lexsort((node[others[good]], -agree[good]))[:QUICK]]]]
            a.append(np.minimum(best, node[i]))
            b.append(np.maximum(best, node[i]))
        return pa.table({"a": np.concatenate(a), "b": np.concatenate(b)})

    return sent.groupBy("bucket", "block").applyInArrow(lambda t: compare(t), "a long, b long")


def _met(members: DataFrame, nodes: DataFrame, compare, schema: str) -> DataFrame:
    """``compare`` over the members of every two blocks of a bucket (and of each
    block by itself) with what ``nodes`` has of them. Members come with
    ``blocks``, for all pairs of blocks, or with the pair (p, q) itself."""
    if "blocks" in members.columns:
        other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("_o")
        members = members.select("bucket", "node", "class", "block", other).select("bucket", F.least("block", "_o").alias("p"), F.greatest("block", "_o").alias("q"), "block", "node", "class")
    columns = [c for c in nodes.columns if c in ("signature", "total", "bag")]
    sent = members.join(nodes.select("node", *columns), "node").select("bucket", "p", "q", "block", "node", "class", *columns)
    return sent.groupBy("bucket", "p", "q").applyInArrow(lambda t: compare(t), schema)


class _Meeting:
    """The members of two blocks of a bucket; class labels that links join."""

    def __init__(self, rows: pa.Table, least: float) -> None:
        self.bucket, self.p, self.q = (rows[c][0].as_py() for c in ("bucket", "p", "q"))
        self.sig = np.frombuffer(b"".join(rows["signature"].to_pylist()), np.uint32).reshape(-1, REGISTERS)
        self.node, self.cls, self.block, self.total = (rows[c].to_numpy() for c in ("node", "class", "block", "total"))
        self.keys, self.least = band_keys(self.sig), least
        self.label = np.unique(self.cls, return_inverse=True)[1]

    def first(self) -> np.ndarray:
        return np.flatnonzero(self.block == self.p)

    def partners(self, i: int) -> np.ndarray:
        """Members not yet joined with member i that look like it; a pair of one
        block is told to its first member, and a pair to the first bucket that it shares."""
        met = self.block == self.q
        if self.p == self.q:
            met[: i + 1] = False
        total = self.total
        # Bags whose weights differ too much cannot overlap enough.
        others = np.flatnonzero(met & (self.label != self.label[i]) & (np.minimum(total, total[i]) >= self.least * np.maximum(total, total[i])))
        others = others[(self.sig[others] == self.sig[i]).sum(1) >= LOOKS_ALIKE]
        return others[self.keys[i][(self.keys[others] == self.keys[i]).argmax(1)] == self.bucket]


def _look_alikes(least: float):
    """The members that look like one of another class, as rows for ``_met``."""

    def run(rows: pa.Table) -> pa.Table:
        meeting = _Meeting(rows, least)
        alike = np.zeros(len(meeting.node), bool)
        for i in meeting.first():
            others = meeting.partners(i)
            alike[others] = True
            alike[i] |= len(others) > 0
        return rows.select(["bucket", "p", "q", "block", "node", "class"]).filter(pa.array(alike))

    return run


def _linked(least: float, audit: bool = False):
    """Links between look-alikes of different classes that join these classes
    (for an audit, the pairs that are compared)."""

    def run(rows: pa.Table) -> pa.Table:
        meeting = _Meeting(rows, least)
        node, total, label = meeting.node, meeting.total, meeting.label
        each = [_parsed(d) for d in rows["bag"].to_pylist()]
        sizes = np.array([len(h) for h, _ in each])
        begin = np.cumsum(sizes) - sizes
        _, shingle = np.unique(np.concatenate([h for h, _ in each]), return_inverse=True)
        weight = np.concatenate([w for _, w in each]).astype(np.int64)
        own = np.zeros(int(shingle.max(initial=-1)) + 1, np.int64)
        a, b = [], []
        for i in meeting.first():
            others = meeting.partners(i)
            mine = slice(begin[i], begin[i] + sizes[i])
            own[shingle[mine]] = weight[mine]
            for lo in range(0, len(others), PAIRS):
                some = others[lo : lo + PAIRS]
                if not audit:
                    some = some[label[some] != label[i]]
                if not len(some):
                    continue
                # The entries of the partners' bags, one after the other.
                ends = np.cumsum(sizes[some])
                at = np.repeat(begin[some] - (ends - sizes[some]), sizes[some]) + np.arange(ends[-1])
                shared = np.add.reduceat(np.minimum(own[shingle[at]], weight[at]), ends - sizes[some])
                linked = some if audit else some[shared >= least * (total[i] + total[some] - shared)]
                for j in linked:
                    if audit or label[j] != label[i]:
                        a.append(min(node[i], node[j]))
                        b.append(max(node[i], node[j]))
                        if not audit:
                            label[label == label[j]] = label[i]
            own[shingle[mine]] = 0
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def near_classes(docs: DataFrame, key: str = "doc_id", text_column: str = "text", least: float = LEAST) -> DataFrame:
    """(key, digest, class_id, first) for every row: ``class_id`` is the least
    key of the row's class, ``first`` whether the row's text is the one of its
    class that stays (that of the least key)."""
    text = text_of(docs, text_column)
    rows = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(NO_KEY)).alias("key"), F.unhex(F.md5(text)).alias("digest"), text.alias("text"))
    sig = stored(signed(rows), "near_signatures")
    reps = sig.groupBy("digest").agg(F.min("key").alias("key"))
    reps = reps.join(sig, ["digest", "key"]).dropDuplicates(["digest"])
    nodes = stored(reps.withColumn("node", F.monotonically_increasing_id()), "near_nodes")
    buckets = _buckets(nodes)
    heads = buckets.groupBy("bucket").agg(F.min("node").alias("head"), F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket", "head")
    shared = stored(buckets.join(heads, "bucket").select("bucket", "node", "head"), "near_buckets")

    def open_buckets(classes: DataFrame) -> DataFrame:
        """The members of buckets that hold several classes."""
        members = shared.join(classes, "node", "left").select("bucket", "node", F.coalesce("component", "node").alias("class"))
        split = members.groupBy("bucket").agg(F.min("class").alias("lo"), F.max("class").alias("hi")).where("lo <> hi").select("bucket")
        return stored(members.join(split, "bucket"), "near_open")

    stars = shared.where("node <> head").select(F.col("head").alias("a"), F.col("node").alias("b")).distinct()
    links = _Links(nodes, rows, least)
    classes = links.compare(_agreeing(stars, nodes, least))
    # What the heads have left open: the best partners in a block, then all.
    for last in (False, True):
        open_ = open_buckets(classes)
        if not open_.take(1):
            break
        dealt = _dealt(open_)
        classes = links.compare_all(dealt) if last else links.compare(_quick(dealt, nodes, least))

    own = nodes.select("digest", "node", "key").join(classes, "node", "left").select("digest", "key", F.coalesce("component", "node").alias("class"))
    # Of a class the least key; among texts of one key the least digest.
    heads = own.groupBy("class").agg(F.min(F.struct("key", "digest")).alias("head"))
    own = own.join(heads, "class").select("digest", F.col("head.key").alias("class_id"), (F.col("head.digest") == F.col("digest")).alias("first"))
    def null_key(c: str) -> F.Column:
        return F.when(F.col(c) != NO_KEY, F.col(c))

    return sig.select("key", "digest").join(own, "digest").select(null_key("key").alias(key), "digest", null_key("class_id").alias("class_id"), "first")


def classes_report(docs: DataFrame) -> DataFrame:
    """doc_id, class_id, kept for every document."""
    found = near_classes(docs.select("doc_id", "text"))
    return found.select("doc_id", "class_id", (F.col("first") & F.col("doc_id").eqNullSafe(F.col("class_id"))).alias("kept"))


def without_near_copies(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """``docs`` with one row of each class: the one of the least key. Rows are
    told apart by key and text, as keys may be NULL or repeated."""
    found = near_classes(docs.select(key, "text"), key)
    one = [F.coalesce(F.col(key).cast("long"), F.lit(NO_KEY)).alias("_key"), F.col("digest").alias("_digest")]
    stays = F.col("first") & F.col(key).eqNullSafe(F.col("class_id"))
    # Rows to drop, and repeated rows, of which one stays. They are stored: the
    # plan below reads them twice, and the driver plans it anew at each step. It
    # is the same plan for few and many of them.
    marks = found.select(*one, stays.alias("_stays")).groupBy("_key", "_digest").agg(F.first("_stays").alias("_stays"), F.count(F.lit(1)).alias("_n"))
    marks = stored(marks.where("NOT _stays OR _n > 1").drop("_n"), "near_marks").hint("merge")
    rows = docs.withColumns({"_key": F.coalesce(F.col(key).cast("long"), F.lit(NO_KEY)), "_digest": F.unhex(F.md5(text_of(docs)))})
    single = rows.join(marks, ["_key", "_digest"], "left_anti")
    # Repeated rows are rare; only they are counted out one by one.
    repeated = rows.join(marks.where("_stays").hint("merge"), ["_key", "_digest"], "left_semi").dropDuplicates(["_key", "_digest"])
    return single.unionByName(repeated).select(*docs.columns)
