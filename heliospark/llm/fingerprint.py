"""Improbable-feature fingerprints of documents.

Every byte window of a text has an entropy; how rare that entropy is over the
whole corpus ranks the windows. The window that is rarest (leftmost) in many
of the neighbourhoods it belongs to is a feature. Feature hashes go into a
chain of Bloom filters of bounded load, and two fingerprints are as alike as
the overlap of their filters' bits, less what chance gives, in proportion to
the greatest overlap possible.

Defined cases: NULL text is empty; an empty text has an empty fingerprint,
alike 1 to another empty one and 0 to any other; a text with fewer than
``FEW`` improbable windows has every ``TINY``-byte window (or itself, if
shorter) as a feature, and so has, for this comparison, any text that it is
compared with (a text with fewer than ``SOME`` keeps them in its fingerprint; a
longer one has them as long as its text is at hand); repeated doc_ids are ordered by a hash of their text;
a NULL doc_id comes last in descending order; an empty table gives an empty
table. Long texts are worked through in blocks, with the same result.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_of

WINDOW = 32  # bytes of a feature
NEAR = 32  # windows of a neighbourhood
POPULAR = 8  # neighbourhoods that a feature must be rarest in
FEW, TINY = 8, 8
SOME = 4 * FEW  # features of a text below which its fingerprint also holds its TINY-byte windows
BITS, PER_FILTER = 2048, 160  # of a Bloom filter; 5 bits a feature
BINS = 512  # of entropy
DULL = 0.2  # share of the greatest entropy below which a window is no feature
BLOCK = 1 << 18  # bytes worked on together
RUN_BYTES = 32 << 20  # of texts in a run of following documents, as planned
PER_RUN = 64  # keys that place the end of a run

FIXED = 1 << 20
_F = np.array([0.0, *(c * np.log2(c) for c in range(1, WINDOW + 1))])
_STEP = np.round(np.diff(_F) * FIXED).astype(np.int64)  # what one more of a byte adds to sum(c log c)
_FULL = int(round(_F[WINDOW] * FIXED))
_POWERS = np.array([pow(0x9E3779B97F4A7C15, WINDOW - 1 - k, 1 << 64) for k in range(WINDOW)], np.uint64)
_TINY_POWERS = _POWERS[-TINY:]


def entropy_bins(x: np.ndarray) -> np.ndarray:
    """Entropy bin of the window starting at each byte but the last few; exact
    integers, so a window has the same bin wherever it stands."""
    n = len(x)
    if n < WINDOW:
        return np.empty(0, np.int32)
    earlier, later = np.zeros(n, np.uint8), np.zeros(n, np.uint8)
    for lag in range(1, WINDOW):
        same = (x[lag:] == x[:-lag]).view(np.uint8)
        earlier[lag:] += same
        later[:-lag] += same
    added, removed = np.cumsum(_STEP[earlier]), np.cumsum(_STEP[later])
    total = added[WINDOW - 1 :].copy()
    total[1:] -= removed[: n - WINDOW]
    # Entropy falls as sum(c log c) grows.
    return ((_FULL - total) * (BINS - 1) // _FULL).astype(np.int32)


def entropy_histogram(docs: DataFrame, text_column: str = "text") -> np.ndarray:
    """Windows of the whole corpus by entropy bin (BINS sums, whatever the corpus)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BINS, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                x = np.frombuffer((text or "").encode(), np.uint8)
                for at in range(0, len(x), BLOCK):
                    total += np.bincount(entropy_bins(x[at : at + BLOCK + WINDOW - 1]), minlength=BINS)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BINS)), pa.array(total)], names=["bin", "n"])

    out = np.zeros(BINS, np.int64)
    for r in docs.select(text_column).mapInArrow(run, "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n")).collect():
        out[r["bin"]] = r["n"]
    return out


def rarity_ranks(histogram: np.ndarray) -> np.ndarray:
    """Rank of each entropy bin, rarest first; bins never seen, or dull, come last."""
    out = np.full(BINS, BINS, np.int32)
    some = np.flatnonzero(histogram)
    some = some[some >= DULL * BINS]
    out[some[np.lexsort((some, histogram[some]))]] = np.arange(len(some))
    return out


def feature_starts(x: np.ndarray, lengths: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Starts of the features of texts that stand one after the other in ``x``."""
    n = len(x)
    if n < WINDOW + NEAR - 1:
        return np.empty(0, np.int64)
    rank = ranks[entropy_bins(x)].astype(np.int64)
    key = (rank << 40) | np.arange(len(rank))
    span = 1
    while span < NEAR:  # least (rank, position) of NEAR windows from each on
        step = min(span, NEAR - span)
        key = np.minimum(key[:-step], key[step:])
        span += step
    ends = np.cumsum(lengths)
    starts = ends - lengths
    # A neighbourhood counts if the bytes of its windows are all of one text.
    whole = np.zeros(n + 1, np.int64)
    fits = lengths >= WINDOW + NEAR - 1
    np.add.at(whole, starts[fits], 1)
    np.add.at(whole, ends[fits] - (WINDOW + NEAR - 2), -1)
    key = key[np.cumsum(whole)[: len(key)] > 0]
    key = key[(key >> 40) < BINS]
    return np.flatnonzero(np.bincount(key & ((1 << 40) - 1), minlength=len(rank)) >= POPULAR)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _window_hashes(x: np.ndarray, starts: np.ndarray, powers: np.ndarray) -> np.ndarray:
    out = np.zeros(len(starts), np.uint64)
    for k, p in enumerate(powers):
        out += (x[starts + k].astype(np.uint64) + np.uint64(1)) * p
    return _mixed(out)


class Fingerprint:
    """A chain of Bloom filters: ``bits`` (filters x 64-bit words), ``loads``
    features in each. ``tiny`` tells that they are TINY-byte windows; else
    ``short`` is the fingerprint of those, or the text to make it of."""

    __slots__ = ("bits", "loads", "tiny", "short")

    def __init__(self, hashes: np.ndarray, tiny: bool = False, short: Fingerprint | bytes | None = None) -> None:
        self.tiny, self.short = tiny, short
        _, first = np.unique(hashes, return_index=True)
        hashes = hashes[np.sort(first)]
        k = -(-len(hashes) // PER_FILTER)
        self.loads = np.array([min(PER_FILTER, len(hashes) - i * PER_FILTER) for i in range(k)], np.int64)
        flags = np.zeros((k, BITS), np.uint8)
        row = np.arange(len(hashes)) // PER_FILTER
        for j in range(5):
            flags[row, ((hashes >> np.uint64(11 * j)) & np.uint64(BITS - 1)).astype(np.int64)] = 1
        self.bits = np.packbits(flags, axis=1).view(np.uint64).reshape(k, BITS // 64)

    def of_tiny_windows(self) -> Fingerprint | None:
        if self.tiny:
            return self
        if isinstance(self.short, bytes):
            self.short = Fingerprint(_tiny_hashes(np.frombuffer(self.short, np.uint8)), True)
        return self.short

    def text(self) -> str:
        """features:filters in base64, empty for an empty text; that of the
        TINY-byte windows, if any, follows a semicolon."""
        if not len(self.loads):
            return ""
        own = f"{int(self.loads.sum())}:" + base64.b64encode(self.bits.tobytes()).decode()
        return ";" + own if self.tiny else own + self.short.text() if isinstance(self.short, Fingerprint) and self.loads.sum() < SOME else own

    @classmethod
    def parse(cls, text: str) -> Fingerprint:
        if not text:
            return cls(np.empty(0, np.uint64))

        def chain(part: str, tiny: bool) -> Fingerprint:
            out = cls(np.empty(0, np.uint64), tiny)
            count, _, data = part.partition(":")
            out.bits = np.frombuffer(base64.b64decode(data), np.uint64).reshape(-1, BITS // 64)
            left = int(count)
            out.loads = np.array([min(PER_FILTER, left - i * PER_FILTER) for i in range(len(out.bits))], np.int64)
            return out

        own, _, short = text.partition(";")
        if not own:
            return chain(short, True)
        out = chain(own, False)
        out.short = chain(short, True) if short else None
        return out

    def likeness(self, other: Fingerprint) -> float:
        """0 to 1: each filter of the shorter chain against the filter of the
        other that it overlaps most, weighted by load. A text of few features
        is compared by the TINY-byte windows of both."""
        if self.tiny != other.tiny and len(self.loads) and len(other.loads):
            x, y = self.of_tiny_windows(), other.of_tiny_windows()
            if x is not None and y is not None:
                return x.likeness(y)
        a, b = sorted((self, other), key=lambda f: (int(f.loads.sum()), f.bits.tobytes()))
        if not len(a.loads):
            return 1.0 if not len(b.loads) else 0.0
        p = 1 - 1 / BITS
        own_b = np.bitwise_count(b.bits).sum(1, dtype=np.int64)
        total = 0.0
        for bits, load in zip(a.bits, a.loads, strict=True):
            overlap = np.bitwise_count(b.bits & bits).sum(1, dtype=np.int64)
            most = np.minimum(int(np.bitwise_count(bits).sum(dtype=np.int64)), own_b)
            chance = BITS * (1 - p ** (5 * load) - p ** (5.0 * b.loads) + p ** (5.0 * (load + b.loads)))
            chance = np.minimum(chance, most - 1)
            total += load * float(np.clip((overlap - chance) / (most - chance), 0, 1).max())
        return total / float(a.loads.sum())


def _tiny_hashes(y: np.ndarray) -> np.ndarray:
    if len(y) >= TINY:
        return _window_hashes(y, np.arange(len(y) - TINY + 1), _TINY_POWERS)
    return _window_hashes(y, np.zeros(1, np.int64), _POWERS[: len(y)])


def _blocks(texts: list[bytes]) -> Iterator[list[int]]:
    """Numbers of texts to work on together."""
    group, size = [], 0
    for i, t in enumerate(texts):
        if group and size + len(t) > BLOCK:
            yield group
            group, size = [], 0
        group.append(i)
        size += len(t)
    if group:
        yield group


def fingerprints(texts: list[bytes], ranks: np.ndarray) -> list[Fingerprint]:
    out: list[Fingerprint | None] = [None] * len(texts)
    for group in _blocks(texts):
        x = np.frombuffer(b"".join(texts[i] for i in group), np.uint8)
        lengths = np.array([len(texts[i]) for i in group], np.int64)
        if len(group) == 1 and len(x) > 2 * BLOCK:
            # Starts in [at, at + BLOCK) need the neighbourhoods that reach them.
            found = []
            for at in range(0, len(x), BLOCK):
                lo, hi = max(0, at - NEAR + 1), min(len(x), at + BLOCK + WINDOW + NEAR)
                s = feature_starts(x[lo:hi], np.array([hi - lo]), ranks) + lo
                found.append(s[(s >= at) & (s < at + BLOCK)])
            starts = np.concatenate(found)
        else:
            starts = feature_starts(x, lengths, ranks)
        hashes = _window_hashes(x, starts, _POWERS)
        ends = np.cumsum(lengths)
        cuts = np.searchsorted(starts, ends)
        at = 0
        for i, end, cut in zip(group, ends, cuts, strict=True):
            own = hashes[at:cut]
            at = cut
            if len(own) < FEW and texts[i]:
                out[i] = Fingerprint(_tiny_hashes(x[end - len(texts[i]) : end]), True)
            else:
                out[i] = Fingerprint(own, short=texts[i])
                if out[i].loads.sum() < SOME and texts[i]:
                    out[i].of_tiny_windows()
    return out


def with_fingerprint(df: DataFrame, text_column: str = "text") -> DataFrame:
    """Add ``fingerprint`` (text form); other columns pass through."""
    from pyspark.sql import types as T

    df = df.drop("fingerprint")
    ranks = rarity_ranks(entropy_histogram(df, text_column))
    k = df.columns.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = fingerprints([(t or "").encode() for t in batch.column(k).to_pylist()], ranks)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([f.text() for f in made], pa.string())], names=[*batch.schema.names, "fingerprint"])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField("fingerprint", T.StringType(), False)]))


LEAST_ID = -(1 << 63)


def run_bounds(rows: DataFrame, runs: int) -> tuple[dict[int, np.ndarray], tuple[int, int] | None]:
    """(bounds, first) to cut (id, tie) rows into runs, in ascending order of id
    and descending order of tie: by id the ties of the last rows of runs, and
    the row that is first in descending order of id. The bounds are keys of
    rows, every one in about PER_RUN of some that their hash picks."""
    n, first = rows.agg(F.count(F.lit(1)), F.max(F.struct("id", F.bitwise_not("tie").alias("t")))).first()
    if not n:
        return {}, None
    picked = F.pmod(F.xxhash64("tie", "id"), F.lit(max(1, n // (PER_RUN * runs)))) == 0
    keys = sorted(((r["id"], r["tie"]) for r in rows.where(picked).distinct().collect()), key=lambda k: (k[0], -k[1]))
    top = (first[0], ~first[1])
    bounds: dict[int, list[int]] = {}
    for i, tie in keys[PER_RUN - 1 :: PER_RUN] if len(keys) >= runs * PER_RUN else keys[:: max(1, len(keys) // runs)]:
        if (i, tie) != top:
            bounds.setdefault(i, []).append(tie)
    return {i: np.array(sorted(ties), np.int64) for i, ties in bounds.items()}, top


def in_descending_runs(docs: DataFrame) -> DataFrame:
    """(run, guest, id, tie, doc_id, text) in sorted partitions, by descending
    id and ascending tie, a hash of the text. Rows are cut into runs of about
    RUN_BYTES, whatever their ids; each run also gets, as guest, the row that
    follows its last one (the first of all after the last of all). One pass of
    the texts through a shuffle."""
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST_ID)).alias("id"), F.xxhash64(text_of(docs)).alias("tie"), F.col("doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    runs = max(docs.sparkSession.sparkContext.defaultParallelism, -(-size // RUN_BYTES))
    bounds, first = run_bounds(rows.select("id", "tie"), runs)
    by_id = np.sort(np.concatenate([np.empty(0, np.int64), *(np.full(len(ties), i, np.int64) for i, ties in bounds.items())]))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, ties = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            # The bounds before a row: of lesser ids, or of its id and greater ties.
            own = np.searchsorted(by_id, ids, "left")
            edge = np.zeros(len(ids), bool)
            for i in np.intersect1d(ids, by_id).tolist():
                mine = ids == i
                own[mine] += len(bounds[i]) - np.searchsorted(bounds[i], ties[mine], "right")
                edge[mine] = np.isin(ties[mine], bounds[i])
            edge = np.flatnonzero(edge)
            last = np.flatnonzero((ids == first[0]) & (ties == first[1]))
            pick = pa.array(np.concatenate([np.arange(len(ids)), edge, last]))
            run = np.concatenate([own, own[edge] + 1, np.zeros(len(last), np.int64)])
            guest = np.concatenate([np.zeros(len(ids), bool), np.ones(len(edge) + len(last), bool)])
            yield pa.RecordBatch.from_arrays([pa.array(run, pa.int64()), pa.array(guest), *(c.take(pick) for c in batch.columns)], names=["run", "guest", *batch.schema.names])

    dealt = rows.mapInArrow(deal, "run long, guest boolean, id long, tie long, doc_id long, text string")
    return dealt.repartition(runs, "run").sortWithinPartitions("run", "guest", F.desc("id"), "tie")


def edited_report(docs: DataFrame) -> DataFrame:
    """For each document: its fingerprint, that of its edited text (the last
    half replaced by the beginning of the next document in descending doc_id)
    and their likeness, and the likeness to the next document's."""
    ranks = rarity_ranks(entropy_histogram(docs.select("text")))
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pairs() -> Iterator[tuple[int, str, str]]:
            """(doc_id, text, next text) of the rows that are no guests."""
            last, served = None, None
            for batch in batches:
                for r, guest, doc, text in zip(*(batch.column(c).to_pylist() for c in ("run", "guest", "doc_id", "text")), strict=True):
                    if guest and served == r:
                        continue  # a row of the same id as the guest before
                    if last is not None and last[0] == r:
                        yield last[1], last[2], text
                    served = r if guest else None
                    last = None if guest else (r, doc, text)

        def made(rows: list[tuple[int, str, str]]) -> pa.RecordBatch:
            edited = []
            for _, text, nxt in rows:
                half = len(text) // 2
                edited.append((text[: len(text) - half] + nxt[:half]).encode())
            own = [text.encode() for _, text, _ in rows]
            # Texts of one run follow each other: the next text is mostly the next row's own.
            extra = [k for k in range(len(rows)) if k + 1 == len(rows) or rows[k][2] is not rows[k + 1][1]]
            all_of = fingerprints([*own, *edited, *(rows[k][2].encode() for k in extra)], ranks)
            n = len(rows)
            following = {k: all_of[2 * n + i] for i, k in enumerate(extra)}
            out = []
            for k, (doc, text, _) in enumerate(rows):
                f, g, h = all_of[k], all_of[n + k], following.get(k) or all_of[k + 1]
                out.append((doc, len(text), hashlib.sha256(edited[k]).hexdigest(), f.text(), g.text(), f.likeness(g), f.likeness(h)))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)

        rows, size = [], 0
        for row in pairs():
            rows.append(row)
            size += len(row[1])
            if size > BLOCK:
                yield made(rows)
                rows, size = [], 0
        if rows:
            yield made(rows)

    return in_descending_runs(docs.select("doc_id", "text")).select("run", "guest", "doc_id", "text").mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
