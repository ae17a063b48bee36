"""Near-duplicate embeddings by navigable small-world graphs per shard.

Equal vectors become one node with a count. Nodes are dealt evenly into
shards; each shard's task builds a hierarchical small-world graph, stored as a
table. Every node then queries every shard in blocks: a beam search walks the
graph for a whole block at once, beams that fill with links are widened, and
each block is audited: some of its queries are answered exactly too, the beam
is widened until it finds their nearest neighbours, near or not, and the block
is searched again with twice the beam until it misses none of their links. Links are verified by cosine in double precision; a block's links
leave its task as counts and as a spanning star of each local component, never
as all pairs, and the stars are united into components.

Defined cases: vectors that are NULL, empty, zero or hold NULL, NaN or
infinite parts link with nothing, nor do vectors of different length; equal
rows link with each other; an empty table gives an empty table; other columns
are not needed and not read.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import component_labels, stored

LINKS = 16  # links of a node in the upper layers; twice as many in the lowest
BEAM_BUILD, BEAM = 64, 32  # beam widths at first
WIDEST = 512  # a query that would need a wider beam is answered by an exact scan of the shard
BEAM_NODES = 256  # a scan of so many nodes takes less than one more place in a beam
AUDITED = 8  # queries of a block that are answered exactly as well
NEAREST, RECALL = 4, 0.95  # neighbours of an audited query, and the share of them to be found
SHARDS = 8  # at least; more when a shard would pass SHARD_BYTES
SHARD_BYTES = 128 << 20  # of a shard's vectors and links, its cell in the table of graphs
BLOCK = 512  # queries walked at once
SLACK = 1e-4  # below the threshold, for single precision on the way


def _best(sims: np.ndarray, width: int) -> np.ndarray:
    """Columns of the greatest ``width`` values of each row, in falling order."""
    width = min(width, sims.shape[1])
    part = np.argpartition(-sims, width - 1, axis=1)[:, :width] if width < sims.shape[1] else np.broadcast_to(np.arange(width), sims.shape)
    return np.take_along_axis(part, np.argsort(-np.take_along_axis(sims, part, 1), axis=1, kind="stable"), 1)


def widest(n: int) -> int:
    """The widest beam worth a walk among ``n`` nodes; beyond, a scan of them
    takes less (a wide beam sees most of a small shard, node by node)."""
    return max(2 * BEAM, min(WIDEST, n // BEAM_NODES))


class Graph:
    """Layered small-world graph over unit vectors (single precision)."""

    def __init__(self, x: np.ndarray) -> None:
        self.x = x
        n = len(x)
        self.widest = widest(n)
        draw = np.random.default_rng(5).random(n)
        self.level = np.minimum((-np.log(np.maximum(draw, 1e-12)) / np.log(LINKS)).astype(int), 12)
        self.order = np.argsort(-self.level, kind="stable")  # highest nodes come first
        top = int(self.level.max()) if n else 0
        # Links by layer; -1 where there are fewer.
        self.links = [np.full((n, 2 * LINKS if layer == 0 else LINKS), -1, np.int32) for layer in range(top + 1)]

    @classmethod
    def build(cls, x: np.ndarray) -> Graph:
        g = cls(x)
        done = 0
        n = len(x)
        while done < n:
            batch = g.order[done : done + max(64, min(1024, done))]
            g._insert(batch, done)
            done += len(batch)
        return g

    def _insert(self, batch: np.ndarray, done: int) -> None:
        """Link a batch to the ``done`` nodes before it and within itself."""
        q = self.x[batch]
        at = None
        within = q @ q.T
        np.fill_diagonal(within, -2.0)
        for layer in range(len(self.links) - 1, -1, -1):
            mine = self.level[batch] >= layer
            if done:
                width = BEAM_BUILD if mine.any() else 1
                ids, sims = self.walk(q, layer, width, at, done)
                at = ids[:, :1]
            else:
                ids, sims = np.empty((len(batch), 0), np.int64), np.empty((len(batch), 0), np.float32)
            if not mine.any():
                continue
            own = np.flatnonzero(mine)
            near = _best(within[np.ix_(own, own)], 2 * LINKS)
            cand = np.concatenate([ids[own], batch[own][near]], 1)
            sim = np.concatenate([sims[own], np.take_along_axis(within[np.ix_(own, own)], near, 1)], 1)
            chosen = self._spread(cand, sim, LINKS)
            table = self.links[layer]
            table[batch[own], : chosen.shape[1]] = chosen
            self._link_back(layer, batch[own], chosen)

    def _spread(self, cand: np.ndarray, sim: np.ndarray, most: int) -> np.ndarray:
        """Of each row's candidates (repeats allowed) the nearest that are nearer
        to the row's node than to any chosen before; then the nearest of the rest."""
        order = np.argsort(-sim, axis=1, kind="stable")
        cand, sim = np.take_along_axis(cand, order, 1), np.take_along_axis(sim, order, 1)
        rows, width = cand.shape
        ok = (cand >= 0) & (sim > -1.5)
        v = self.x[np.where(ok, cand, 0)]
        between = np.matmul(v, v.transpose(0, 2, 1))
        same = cand[:, :, None] == cand[:, None, :]
        chosen, spare = np.zeros((rows, width), bool), np.zeros((rows, width), bool)
        count = np.zeros(rows, int)
        for c in range(width):
            again = (same[:, c, :c] & (chosen[:, :c] | spare[:, :c])).any(1)
            hidden = ((between[:, c, :c] >= sim[:, c, None]) & chosen[:, :c]).any(1)
            free = ok[:, c] & ~again
            chosen[:, c] = free & ~hidden & (count < most)
            spare[:, c] = free & ~chosen[:, c]
            count += chosen[:, c]
        rank = np.where(chosen, 0, np.where(spare, 1, 2)) * width + np.arange(width)
        first = np.argsort(rank, axis=1, kind="stable")[:, : min(most, width)]
        usable = np.take_along_axis(chosen | spare, first, 1)
        return np.where(usable, np.take_along_axis(cand, first, 1), -1).astype(np.int32)

    def _link_back(self, layer: int, sources: np.ndarray, chosen: np.ndarray) -> None:
        """Add the reverse of new links, keeping the best spread of each target's."""
        table = self.links[layer]
        s, t = np.repeat(sources, chosen.shape[1]), chosen.ravel()
        s, t = s[t >= 0], t[t >= 0]
        if not len(t):
            return
        order = np.argsort(t, kind="stable")
        s, t = s[order], t[order]
        targets, first, counts = np.unique(t, return_index=True, return_counts=True)
        for lo in range(0, len(targets), 4096):
            some, c = targets[lo : lo + 4096], counts[lo : lo + 4096]
            # Sources of a target in rows of at most 64; a busier target takes more than one round.
            for skip in range(0, int(c.max()), 64):
                busy = np.flatnonzero(c > skip)
                take = np.minimum(c[busy] - skip, 64)
                new = np.full((len(busy), int(take.max())), -1, np.int64)
                col = np.arange(new.shape[1])
                has = col < take[:, None]
                new[has] = s[(first[lo : lo + 4096][busy][:, None] + skip + col)[has]]
                who = some[busy]
                cand = np.concatenate([table[who], new], 1)
                sim = np.einsum("rd,rcd->rc", self.x[who], self.x[np.maximum(cand, 0)])
                sim[cand < 0] = -2.0
                table[who] = self._spread(cand, sim, table.shape[1])

    def walk(self, q: np.ndarray, layer: int, width: int, start: np.ndarray | None, done: int) -> tuple[np.ndarray, np.ndarray]:
        """Beam search of all queries at once in a layer: ids and similarities
        of the best ``width`` nodes met, falling (-1 and -2 where fewer)."""
        rows = len(q)
        table = self.links[layer]
        if start is None:
            start = np.full((rows, 1), self.order[0])
        seen = np.zeros((rows, len(self.x)), bool)
        line = np.arange(rows)[:, None]
        ids = np.full((rows, width), -1, np.int64)
        sims = np.full((rows, width), -2.0, np.float32)
        fresh = np.zeros((rows, width), bool)
        k = min(start.shape[1], width)
        ids[:, :k] = start[:, :k]
        seen[line, start] = True
        sims[:, :k] = np.einsum("rd,rcd->rc", q, self.x[np.maximum(ids[:, :k], 0)])
        fresh[:, :k] = ids[:, :k] >= 0
        active = np.arange(rows)
        step = 1 if width < 8 else 4  # nodes opened at once
        while len(active):
            cols = _best(np.where(fresh[active], sims[active], -3.0), step)
            a = active[:, None]
            open_ = fresh[a, cols]
            fresh[a, cols] = False
            next_ = table[np.where(open_, ids[a, cols], 0)]
            next_ = np.where(open_[:, :, None], next_, -1).reshape(len(active), -1)
            ok = (next_ >= 0) & ~seen[a, np.maximum(next_, 0)]
            # A node met twice in this round counts once.
            order = np.argsort(next_, axis=1, kind="stable")
            sorted_ = np.take_along_axis(next_, order, 1)
            twice = np.zeros_like(ok)
            np.put_along_axis(twice, order[:, 1:], sorted_[:, 1:] == sorted_[:, :-1], 1)
            ok &= ~twice
            r, c = np.nonzero(ok)
            found = next_[r, c]
            seen[active[r], found] = True
            sim = np.full(next_.shape, -2.0, np.float32)
            sim[r, c] = np.einsum("fd,fd->f", q[active[r]], self.x[found])
            all_s = np.concatenate([sims[active], sim], 1)
            all_i = np.concatenate([ids[active], np.where(ok, next_, -1)], 1)
            all_f = np.concatenate([fresh[active], ok], 1)
            keep = _best(all_s, width)
            sims[active] = np.take_along_axis(all_s, keep, 1)
            ids[active] = np.take_along_axis(all_i, keep, 1)
            fresh[active] = np.take_along_axis(all_f, keep, 1)
            active = active[fresh[active].any(1)]
        return ids, sims

    def search(self, q: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        at = None
        for layer in range(len(self.links) - 1, 0, -1):
            at = self.walk(q, layer, 1, at, len(self.x))[0]
        return self.walk(q, 0, width, at, len(self.x))

    def near(self, q: np.ndarray, least: float, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, node) pairs found with similarity at least ``least``. The beam
        of a query that is full of links is doubled until it is not."""
        left = np.arange(len(q))
        rows, nodes = [], []
        while len(left):
            if width > self.widest:
                r, c = self.scan(q[left], least)
                rows.append(left[r])
                nodes.append(c)
                break
            ids, sims = self.search(q[left], width)
            full = sims[:, -1] >= least
            r, c = np.nonzero((sims >= least) & ~full[:, None])
            rows.append(left[r])
            nodes.append(ids[r, c])
            left = left[full]
            width *= 2
        return np.concatenate([*rows, np.empty(0, np.int64)]), np.concatenate([*nodes, np.empty(0, np.int64)])

    def width_for(self, q: np.ndarray) -> int:
        """The least beam that finds RECALL of the NEAREST nearest neighbours of
        the given queries, whatever their similarity."""
        sims = q @ self.x.T
        best = _best(sims, NEAREST)
        width = BEAM
        while width <= self.widest:
            ids, _ = self.search(q, width)
            found = (ids[:, :, None] == best[:, None, :]).any(1)
            if found.mean() >= RECALL:
                break
            width *= 2
        return width

    def audited(self, q: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray, int]:
        """Like ``near``, with a beam that the audited queries bear out: it finds
        their nearest neighbours, and misses none of their links."""
        sample = np.unique(np.linspace(0, len(q) - 1, AUDITED).astype(int))
        width = self.width_for(q[sample])
        exact = q[sample] @ self.x.T >= least
        while True:
            rows, nodes = self.near(q, least, width)
            got = np.zeros(exact.shape, bool)
            place = np.searchsorted(sample, rows)
            audited = sample[np.minimum(place, len(sample) - 1)] == rows
            got[place[audited], nodes[audited]] = True
            if width > self.widest or not (exact & ~got).any():
                return rows, nodes, width
            width *= 2

    def scan(self, q: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
        """The same pairs without the graph."""
        rows, nodes = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for lo in range(0, len(self.x), 16_384):
            r, c = np.nonzero(q @ self.x[lo : lo + 16_384].T >= least)
            rows.append(r)
            nodes.append(c + lo)
        return np.concatenate(rows), np.concatenate(nodes)


def _unit(raw: np.ndarray) -> np.ndarray:
    return (raw / np.linalg.norm(raw, axis=1, keepdims=True)).astype(np.float32)


def _stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning star (node, least node) of each component of the links a-b."""
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = flat[: len(a)], flat[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    out = label != np.arange(len(nodes))
    return nodes[out], nodes[label[out]]


def _matrix(column: pa.ListArray | pa.ChunkedArray) -> np.ndarray:
    return np.stack(column.to_numpy(zero_copy_only=False)).astype(np.float64) if len(column) else np.empty((0, 0))


def usable(embedding: str = "embedding") -> F.Column:
    v = F.col(embedding)
    return (
        F.coalesce(F.size(v) > 0, F.lit(False))
        & ~F.coalesce(F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))), F.lit(True))
        & F.coalesce(F.exists(v, lambda x: x != 0), F.lit(False))
    )


def linked_nodes(nodes: DataFrame, least: float) -> DataFrame:
    """(node, other, weight) rows over (node, weight, embedding): with other
    NULL, the summed weight of the nodes linked with ``node`` (part of it by
    shard); else an edge of a spanning star."""
    dims = nodes.withColumn("dim", F.size("embedding"))
    size = dims.agg(F.sum(8 * F.col("dim") + 4 * 4 * LINKS)).first()[0] or 0
    shards = max(SHARDS, -(-size // SHARD_BYTES))
    dims = dims.withColumn("shard", F.pmod(F.xxhash64("node"), F.lit(shards)))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def index(dim: int, shard: int, parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            t = pa.Table.from_batches(parts)
            raw = _matrix(t["embedding"].combine_chunks())
            g = Graph.build(_unit(raw))
            data = io.BytesIO()
            np.savez(data, raw=raw, node=t["node"].to_numpy(), weight=t["weight"].to_numpy(), level=g.level, order=g.order, **{f"links{k}": v for k, v in enumerate(g.links)})
            return pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), pa.array([shard], pa.int64()), pa.array([data.getvalue()], pa.binary())], names=["dim", "shard", "data"])

        key, parts = None, []
        for batch in batches:
            d, s = batch.column("dim").to_numpy(), batch.column("shard").to_numpy()
            cuts = [0, *(np.flatnonzero((d[1:] != d[:-1]) | (s[1:] != s[:-1])) + 1).tolist(), len(d)]
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                if lo == hi:
                    continue
                if key not in (None, (int(d[lo]), int(s[lo]))):
                    yield index(*key, parts)
                    parts = []
                key = int(d[lo]), int(s[lo])
                parts.append(batch.slice(lo, hi - lo))
        if parts:
            yield index(*key, parts)

    graphs = stored(dims.select("dim", "shard", "node", "weight", "embedding").repartition(shards, "dim", "shard").sortWithinPartitions("dim", "shard", "node").mapInArrow(build, "dim int, shard long, data binary"), "graphs")

    # A slice of the queries meets a shard in one task: first the graph, then the queries as a stream.
    slices = max(2, -(-shards * dims.sparkSession.sparkContext.defaultParallelism // (8 * shards)))
    payload = graphs.select("dim", "shard", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"), F.lit(-1).cast("long").alias("node"), F.lit(None).cast(nodes.schema["embedding"].dataType).alias("embedding"), "data")
    queries = dims.select("dim", F.col("node"), "embedding").withColumn("slice", F.pmod(F.xxhash64("node", F.lit(1)), F.lit(slices)).cast("int")).join(graphs.select("dim", "shard"), "dim")
    queries = queries.select("dim", "shard", "slice", "node", "embedding", F.lit(None).cast("binary").alias("data"))
    meeting = payload.unionByName(queries).repartition(shards * slices, "dim", "shard", "slice").sortWithinPartitions("dim", "shard", "slice", "node")

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        graph = raw = node = weight = None

        def answer(ids: np.ndarray, vectors: np.ndarray) -> pa.RecordBatch:
            rows, found, _ = graph.audited(_unit(vectors), least - SLACK)
            a, b = vectors[rows], raw[found]
            cos = np.einsum("rd,rd->r", a, b) / (np.linalg.norm(a, axis=1) * np.linalg.norm(b, axis=1))
            good = (cos >= least) & (ids[rows] != node[found])
            rows, found = rows[good], found[good]
            total = np.bincount(rows, weight[found], len(ids)).astype(np.int64)
            some = np.flatnonzero(total)
            p, q = _stars(ids[rows], node[found])
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([ids[some], p])), pa.array(np.concatenate([np.zeros(len(some), np.int64), q]), mask=np.arange(len(some) + len(p)) < len(some)), pa.array(np.concatenate([total[some], np.zeros(len(p), np.int64)]))],
                names=["node", "other", "weight"],
            )

        for batch in batches:
            kinds = batch.column("data").is_valid().to_numpy(zero_copy_only=False)
            at = 0
            for k in [*np.flatnonzero(kinds).tolist(), len(kinds)]:
                for lo in range(at, k, BLOCK):
                    part = batch.slice(lo, min(BLOCK, k - lo))
                    yield answer(part.column("node").to_numpy(), _matrix(part.column("embedding")))
                at = k + 1
                if k < len(kinds):
                    with np.load(io.BytesIO(batch.column("data")[k].as_py())) as f:
                        raw, node, weight = f["raw"], f["node"], f["weight"]
                        graph = Graph.__new__(Graph)
                        graph.x, graph.level, graph.order, graph.widest = _unit(raw), f["level"], f["order"], widest(len(raw))
                        graph.links = [f[f"links{i}"] for i in range(len(f.files) - 5)]

    return meeting.mapInArrow(ask, "node long, other long, weight long")


def near_duplicates(vectors: DataFrame, least: float = 0.95) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of (vec_id, embedding)."""
    rows = vectors.select("vec_id", "embedding")
    good = rows.where(usable())
    nodes = good.groupBy("embedding").agg(F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("weight"))
    nodes = stored(nodes.withColumn("node", F.monotonically_increasing_id()), "vector_nodes")
    found = stored(linked_nodes(nodes.select("node", "weight", "embedding"), least), "vector_links")
    labels = component_labels(found.where("other IS NOT NULL").select(F.col("node").alias("a"), F.col("other").alias("b")), "vector_components")
    links = found.where("other IS NULL").groupBy("node").agg(F.sum("weight").alias("others"))
    known = nodes.join(labels, "node", "left").join(links, "node", "left").select("embedding", "first_id", F.coalesce("component", "node").alias("component"), (F.coalesce("others", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    known = known.join(known.groupBy("component").agg(F.min("first_id").alias("component_id")), "component")
    out = good.join(known.select("embedding", "n_links", "component_id"), "embedding").select("vec_id", "n_links", "component_id")
    out = out.unionByName(rows.where(~usable()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
