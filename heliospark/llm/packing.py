"""Best-fit packing of tokenised documents with a swap-based local search.

Documents become pieces: one each, or full sequences with a shorter first
piece when longer than a sequence. Pieces are dealt evenly into groups of a
bounded size (by row number, so no key can be hot); each group is packed
best-fit decreasing, then items move between its underfull bins - single
moves, one-for-one and two-for-one exchanges - whenever that raises the sum of
squared fills, until nothing improves. Only (length, checksum)
rows are shuffled, never texts or ids.

Defined cases: NULL or empty text is the end id alone; repeated rows are
packed each; ties by row order; an empty table gives an empty table.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

GROUP_PIECES = 40_000  # pieces packed together by one task

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_TOKENIZERS: dict[str, object] = {}


def _batch_encoder(path: str):
    """ids of texts by the byte-level BPE in a tokenizer file. No special token
    is added, but one written out in a text has its own id, as in the library. The file's vocabulary and its pattern are run by tiktoken, which
    gives the same ids at a quarter of the time (tests compare the two)."""
    if path not in _TOKENIZERS:
        import public_tokenizers
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes written as themselves in such files
        other = [b for b in range(256) if b not in plain]
        byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}
        ranks = {bytes(byte[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
        _TOKENIZERS[path] = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
    return _TOKENIZERS[path]


def document_pieces(docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every piece of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = partial(_batch_encoder(path).encode, allowed_special="all")
        for batch in batches:
            doc, piece, start, length, crc = [], [], [], [], []
            for d, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.array([*encode(text or ""), end_id], "<u4")
                first = len(ids) % capacity or capacity
                at = 0
                for k in range(-(-len(ids) // capacity)):
                    to = first + k * capacity
                    doc.append(d)
                    piece.append(k)
                    start.append(at)
                    length.append(to - at)
                    crc.append(zlib.crc32(ids[at:to].tobytes()))
                    at = to
            yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECES)


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[list[list[int]], list[int]]:
    """Best-fit decreasing. Bins as lists of item numbers, and their slack.
    A bitmap over slacks finds the tightest bin that takes an item."""
    bins: list[list[int]] = []
    slack: list[int] = []
    by_slack: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_slacks = 0
    order = np.argsort(-lengths, kind="stable").tolist()
    sizes = lengths.tolist()
    for item in order:
        n = sizes[item]
        fits = open_slacks >> n
        if fits:
            s = n + (fits & -fits).bit_length() - 1
            b = by_slack[s].pop()
            if not by_slack[s]:
                open_slacks ^= 1 << s
            bins[b].append(item)
        else:
            s, b = capacity, len(bins)
            bins.append([item])
            slack.append(0)
        slack[b] = s = s - n
        if s:
            by_slack[s].append(b)
            open_slacks |= 1 << s
    return bins, slack


def swap_search(lengths: np.ndarray, bins: list[list[int]], slack: list[int], passes: int | None = None) -> None:
    """Local search over the underfull bins, in place; emptied bins stay as [].

    For an item y of a bin, the receivers are all items x of other underfull
    bins (x = nothing for a move): y (or a pair of y) goes over and x comes
    back. A change is taken when it raises the sum of squared fills, the one
    that fills its receiver most first. The sum only rises, so the search
    ends; it goes on until no change is left (or for ``passes`` rounds).
    """
    under = [b for b, s in enumerate(slack) if s]
    if len(under) < 2:
        return
    capacity = int(lengths[bins[under[0]]].sum()) + slack[under[0]]
    # One row per (bin, item) and one per bin for "nothing".
    home = np.array([b for b in under for _ in range(len(bins[b]) + 1)])
    item = np.array([x for b in under for x in (*bins[b], -1)])
    size = np.where(item >= 0, lengths[item], 0)
    slacks = np.array(slack)
    fills = capacity - slacks
    rows: dict[int, list[int]] = {}
    for r, b in enumerate(home.tolist()):
        rows.setdefault(b, []).append(r)

    def best(a: int, gives: np.ndarray | int) -> tuple[int, int]:
        """(row, tokens) of the exchange from bin ``a`` that raises the squares
        and fills its receiver most, or (-1, 0). ``gives`` are the tokens to
        give, or a table of the most that can be given up to each number."""
        room = slacks[home]
        give = gives[np.minimum(size + room, capacity)] if isinstance(gives, np.ndarray) else np.where(gives <= size + room, gives, -1)
        d = give - size
        good = (give > 0) & (d > 0) & (home != a) & (fills[home] + d > fills[a])
        if not good.any():
            return -1, 0
        r = int(np.argmin(np.where(good, room - d, capacity + 1)))
        return r, int(give[r])

    def exchange(a: int, out: list[int], r: int) -> None:
        """Items on rows ``out`` of bin a against the item on row r."""
        b = int(home[r])
        d = int(size[out].sum()) - int(size[r])
        back = int(item[r])
        rows[a] = [x for x in rows[a] if x not in out]
        rows[b] = [*rows[b], *out]
        home[out] = b
        if back >= 0:
            rows[b].remove(r)
            rows[a].append(r)
            home[r] = a
        for x, by in ((a, -d), (b, d)):
            slacks[x] -= by
            fills[x] += by

    def pairs(own: list[int]) -> tuple[np.ndarray, dict[int, tuple[int, int]]]:
        """By number of tokens the greatest sum of two items up to it (-1 for
        none), and two rows for each sum. Items of one size are alike, and a
        bin has few sizes: they add up to its capacity at most."""
        of_size: dict[int, list[int]] = {}
        for r in own:
            of_size.setdefault(int(size[r]), []).append(r)
        sums = {}
        for m, some in of_size.items():
            for n, others in of_size.items():
                if m < n:
                    sums.setdefault(m + n, (some[0], others[0]))
                elif m == n and len(some) > 1:
                    sums.setdefault(m + n, (some[0], some[1]))
        table = np.full(capacity + 1, -1)
        for total in sums:
            table[total] = total
        return np.maximum.accumulate(table), sums

    done = 0
    while passes is None or done < passes:
        done += 1
        changed = False
        for a in sorted(under, key=lambda b: int(fills[b])):
            if not 0 < fills[a] < capacity:
                continue
            own = [r for r in rows[a] if item[r] >= 0]
            moved = False
            for r in sorted(own, key=lambda r: -int(size[r])):
                if home[r] == a and fills[a] < capacity and (to := best(a, int(size[r]))[0]) >= 0:
                    exchange(a, [r], to)
                    changed = moved = True
            if not moved and len(own) > 1:
                table, sums = pairs(own)
                to, total = best(a, table)
                if to >= 0:
                    exchange(a, list(sums[total]), to)
                    changed = True
        if not changed:
            break
    for b in under:
        bins[b] = [int(item[r]) for r in rows[b] if item[r] >= 0]
        slack[b] = int(slacks[b])


def pack(pieces: DataFrame, capacity: int = 2048, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows with a ``length``."""
    pieces = stored(pieces.drop("sequence_id", "offset"), "pieces")
    groups = max(1, -(-pieces.count() // group_pieces))
    dealt = pieces.withColumn("_group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        lengths = rows["length"].to_numpy()
        bins, slack = best_fit(lengths, capacity)
        swap_search(lengths, bins, slack)
        sequence, offset = np.empty(len(rows), np.int64), np.empty(len(rows), np.int64)
        for k, items in enumerate(x for x in bins if x):
            sequence[items] = k
            offset[items] = np.cumsum(lengths[items]) - lengths[items]
        return rows.drop(columns="_group").assign(sequence_id=(int(rows["_group"].iloc[0]) << 32) + sequence, offset=offset)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return dealt.groupBy("_group").applyInPandas(run, f"{schema}, sequence_id long, offset long")


def packed_documents(docs: DataFrame, path: str, capacity: int = 2048) -> DataFrame:
    return pack(document_pieces(docs, path, capacity), capacity)
