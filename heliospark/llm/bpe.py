"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

A pre-token's bytes form a linked list; every adjacent pair that is a token
waits in the bucket of its rank. A two-level bitmap over the ranks gives the
next non-empty bucket by find-first-set, positions leave a bucket leftmost
first, and entries whose pair has changed meanwhile are skipped as stale. Each
merge costs a constant number of queue operations, so a pre-token of any
length is encoded in near-linear time.

Defined cases: NULL or empty text has no ids and decodes to no bytes; repeated
rows and an empty table map row by row; columns named like an output are
replaced.
"""

from __future__ import annotations

import base64
import heapq
import struct
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Memory of a task: words and pre-tokens remembered (a memory is emptied when
# full) and the longest one worth remembering, in characters. A pre-token costs
# more to find again than a word, which is made of known ones.
WORDS_REMEMBERED, REMEMBERED = 150_000, 1_200_000
LONGEST_REMEMBERED = 48
# Up to this length a bucket's positions are a bitmap, beyond it a heap.
SHORT = 128
NONE = 1 << 31  # the rank of a pair that is no token
PACK = struct.Struct("=i").pack


class Coder:
    """Encoder and decoder of one rank file."""

    def __init__(self, path: str, pattern: str) -> None:
        import regex

        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.bytes_of = {rank: token for token, rank in self.ranks.items()}
        self.longest = max(map(len, self.ranks))
        # Rank of every pair of bytes, NONE where the pair is no token.
        self.byte_pairs = [self.ranks.get(bytes((a, b)), NONE) for a in range(256) for b in range(256)]
        self.split = regex.compile(pattern).findall
        self.pieces: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    def merge(self, piece: bytes) -> bytes:
        """Token ids of one pre-token, packed as 32-bit integers.

        ``top`` has a bit for each non-empty word, ``words[w]`` a bit for each
        rank of that word with a bucket, ``buckets[rank]`` the positions: as a
        bitmap too for a short pre-token, as a heap for a long one. A pair
        that a neighbour of lower rank overlaps cannot join before that one
        has, which makes a new pair of it; so only pairs that no neighbour
        undercuts wait in a bucket, and a pair is queued when it becomes one.
        """
        ranks, longest = self.ranks, self.longest
        whole = ranks.get(piece)
        if whole is not None:
            return PACK(whole)
        n = len(piece)
        byte_pairs = self.byte_pairs
        pair = [byte_pairs[a << 8 | b] for a, b in zip(piece, piece[1:], strict=False)]
        pair += (NONE, NONE)
        after, before = list(range(1, n + 2)), list(range(-1, n))
        short = n <= SHORT
        top, words, buckets = 0, {}, {}
        left = NONE
        fresh = []
        for i, r in enumerate(pair):
            if r < left and r <= pair[i + 1]:
                fresh.append(i)
            left = r
        while True:
            if top or len(fresh) != 1:
                for i in fresh:
                    r = pair[i]
                    if r in buckets:
                        if short:
                            buckets[r] |= 1 << i
                        else:
                            heapq.heappush(buckets[r], i)
                    else:
                        buckets[r] = 1 << i if short else [i]
                        w = r >> 8
                        words[w] = words.get(w, 0) | 1 << (r & 255)
                        top |= 1 << w
                if not top:
                    break
                w = (top & -top).bit_length() - 1
                word = words[w]
                low = word & -word
                rank = w << 8 | low.bit_length() - 1
                bucket = buckets[rank]
                if short:
                    first = bucket & -bucket
                    i = first.bit_length() - 1
                    bucket ^= first
                    if bucket:
                        buckets[rank] = bucket
                else:
                    i = heapq.heappop(bucket)
                if not bucket:
                    del buckets[rank]
                    words[w] = word = word ^ low
                    if not word:
                        top ^= 1 << w
            else:  # an only entry is the next one
                i = fresh[0]
                rank = pair[i]
            fresh = []
            if pair[i] != rank:
                continue  # stale: one of the two has merged meanwhile
            j = after[i]
            end = after[i] = after[j]
            pair[j] = NONE
            before[end] = i
            # The new pairs on both sides, then which of the four pairs around wait now.
            right = pair[i] = ranks.get(piece[i : after[end]], NONE) if end < n and after[end] - i <= longest else NONE
            far = pair[end] if end < n else NONE
            a = before[i]
            if a >= 0:
                new = pair[a] = ranks.get(piece[a:end], NONE) if end - a <= longest else NONE
                b = before[a]
                outer = pair[b] if b >= 0 else NONE
                if new < outer and new <= right:
                    fresh.append(a)
                elif outer <= new and b >= 0 and outer < NONE:
                    c = before[b]
                    if c < 0 or outer < pair[c]:
                        fresh.append(b)
                left = new
            else:
                left = NONE
            if right < left and right <= far:
                fresh.append(i)
            elif far < right:
                d = after[end]
                if d >= n or far <= pair[d]:
                    fresh.append(end)
        out, i = array("i"), 0
        while i < n:
            j = after[i]
            out.append(ranks[piece[i:j]])
            i = j
        return out.tobytes()

    def of(self, piece: str) -> bytes:
        ids = self.merge(piece.encode())
        if len(piece) <= LONGEST_REMEMBERED:
            if len(self.pieces) >= REMEMBERED:
                self.pieces.clear()
            self.pieces[piece] = ids
        return ids

    def text(self, text: str) -> bytes:
        known, of = self.pieces.get, self.of
        return b"".join([known(p) or of(p) for p in self.split(text)])

    def word(self, word: str) -> bytes | None:
        """Ids of one space and a word, whatever stands around them, or None
        if that depends on it (the word is empty or has white space at an end)."""
        if not word or word[0].isspace() or word[-1].isspace():
            return None
        ids = self.text(" " + word)
        if len(word) <= LONGEST_REMEMBERED:
            if len(self.words) >= WORDS_REMEMBERED:
                self.words.clear()
            self.words[word] = ids
        return ids

    def encode(self, text: str) -> np.ndarray:
        """Token ids of a text."""
        first, *rest = text.split(" ")
        if first[-1:].isspace():
            return np.frombuffer(self.text(text), np.int32)
        known, word = self.words.get, self.word
        each = [known(w) or word(w) for w in rest]
        if None in each:
            return np.frombuffer(self.text(text), np.int32)
        return np.frombuffer(self.text(first) + b"".join(each), np.int32)

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


_CODERS: dict[tuple[str, str], Coder] = {}


def coder(path: str, pattern: str) -> Coder:
    """The process's coder of a rank file (kept between tasks of a worker)."""
    if (path, pattern) not in _CODERS:
        _CODERS[path, pattern] = Coder(path, pattern)
    return _CODERS[path, pattern]


def encode(df: DataFrame, path: str, pattern: str, text_column: str = "text", decoded: bool = False) -> DataFrame:
    """Replace the text by ``ids`` (array<int>) and, if asked, add ``decoded``
    (binary), the bytes that the ids decode to. Other columns pass through."""
    keep = [c for c in df.columns if c not in (text_column, "ids", "decoded")]
    fields = [df.schema[c] for c in keep] + [T.StructField("ids", T.ArrayType(T.IntegerType(), False), False)]
    if decoded:
        fields.append(T.StructField("decoded", T.BinaryType(), False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(path, pattern)
        for batch in batches:
            coded = [own.encode(text or "") for text in batch.column(len(keep)).to_pylist()]
            raw = [own.decode(ids.tolist()) for ids in coded] if decoded else []
            ends = np.cumsum([0, *map(len, coded)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*coded, np.empty(0, np.int32)])))
            made = [lists, pa.array(raw, pa.binary())] if decoded else [lists]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *made], names=[f.name for f in fields])

    return df.select(*keep, text_column).mapInArrow(run, T.StructType(fields))


def decode(df: DataFrame, path: str, pattern: str) -> DataFrame:
    """Add ``decoded`` (binary) from ``ids``; NULL ids decode to no bytes."""
    df = df.drop("decoded")
    schema = T.StructType([*df.schema.fields, T.StructField("decoded", T.BinaryType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(path, pattern)
        for batch in batches:
            raw = [own.decode(ids or []) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(raw, pa.binary())], names=[*batch.schema.names, "decoded"])

    return df.mapInArrow(run, schema)


def round_trip_report(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per document: number of ids, digest of the ids, digest of the decoded bytes."""
    coded = encode(docs.select("doc_id", "text"), path, pattern, decoded=True)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
