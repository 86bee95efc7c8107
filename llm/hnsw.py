"""Near-copies among vectors by hierarchical navigable small-world graphs, one per shard.

Equal vectors count as one. Each shard of the others gets a layered graph: a vector
reaches layer ``l`` with odds ``M ** -l``, and links on each layer to neighbours
picked so that none is nearer to another one picked. Every vector is searched for in
every shard: a beam walks down the layers, widened for a query as long as all it
holds is similar, and for all queries of a task until an audit passes, in which
sampled queries are compared with the whole shard; a beam as wide as the shard is an
exact scan. What is found is verified by the cosine in double precision, and links
are united into components, first inside a task, then over all tasks.

Search is vectorised over queries. A task holds one shard and a part of the queries.
Their numbers follow from the distinct vectors of a dimension and its size, so that a
shard is at most about ``SHARD_BYTES`` of vectors and links and a part ``PART_BYTES`` of
vectors at any size of the table. As every vector is asked in every shard, work grows
with vectors times shards; shards are few and large for that.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from llm.graph import connected_components
from llm.shared import stage

SIMILAR = 0.9
SHARD_BYTES = 64 << 20
PART_BYTES = 8 << 20
#: So many shards and parts at least, to give every core work.
SHARDS, PARTS = 8, 4
M = 16
BUILD_BEAM = 48
BEAM = 64
EXPAND = 4
AUDIT = 64
RECALL = 0.995
NEAREST = 0.9
BLOCK = 1024

VECTOR = "vec_id long, dim int, vec binary"
NODE = "dim int, shard int, place int, vec_id long, copies long, vec binary, layers binary"
LINKED = "vec_id long, links long, root long"


class Graph:
    """Vectors of one shard and their neighbours per layer; -1 is no neighbour."""

    def __init__(self, vectors: np.ndarray, layers: np.ndarray | None = None) -> None:
        self.x = vectors.astype(np.float32)
        n = len(vectors)
        rng = np.random.default_rng(3)
        self.level = np.minimum((-np.log(1 - rng.random(n)) / np.log(M)).astype(int), 3)
        if layers is not None:
            self.layers = layers
            self.top = int(np.flatnonzero((layers >= 0).any(axis=(0, 2)))[-1]) if (layers >= 0).any() else 0
            self.entries = np.flatnonzero(self.level >= self.top)[:8] if self.top else np.arange(min(n, 8))
            return
        self.layers = np.full((n, 4, 2 * M), -1, np.int32)
        self.level[0] = max(self.level[0], self.level.max()) if n else 0
        self.top, self.entries, done, size = 0, np.arange(min(n, 1)), 0, 32
        while done < n:
            batch = np.arange(done, min(done + size, n))
            self._insert(batch)
            done += len(batch)
            size = min(size * 2, BLOCK, max(32, done))

    def _insert(self, batch: np.ndarray) -> None:
        first = batch[0]
        starts = np.repeat(self.entries[None, :], len(batch), axis=0)
        for layer in range(3, -1, -1):
            here = batch[self.level[batch] >= layer]
            found = None
            if first and layer <= self.top:
                # Nodes below this layer only pass through it.
                beam = BUILD_BEAM if len(here) else 8
                found, _ = self._walk(self.x[batch], starts, layer, beam)
                starts = found[:, :8]
            if not len(here):
                continue
            near = self._nearest(here, here, min(len(here), BUILD_BEAM))
            if found is not None:
                near = np.concatenate([near, found[self.level[batch] >= layer]], axis=1)
            self._connect(here, near, layer)
        high = int(self.level[batch].max())
        if high > self.top or not first:
            self.top = max(self.top, high)
            self.entries = np.flatnonzero(self.level[: batch[-1] + 1] >= self.top)[:8]

    def _nearest(self, rows: np.ndarray, pool: np.ndarray, k: int) -> np.ndarray:
        sims = self.x[rows] @ self.x[pool].T
        sims[rows[:, None] == pool[None, :]] = -9
        return pool[np.argsort(-sims, axis=1)[:, :k]]

    def _connect(self, rows: np.ndarray, candidates: np.ndarray, layer: int) -> None:
        self.layers[rows, layer, :M] = self._pick(rows, candidates, M)
        # Links back: what is new for each node joins what it has, and the best stay.
        source = np.repeat(rows, M)
        target = self.layers[rows, layer, :M].ravel()
        source, target = source[target >= 0], target[target >= 0]
        if not len(target):
            return
        sims = np.einsum("ij,ij->i", self.x[source], self.x[target])
        order = np.lexsort((-sims, target))
        source, target = source[order], target[order]
        starts = np.flatnonzero(np.append(True, target[1:] != target[:-1]))
        place = np.arange(len(target)) - np.repeat(starts, np.diff(np.append(starts, len(target))))
        keep = place < 4 * M
        nodes = target[starts]
        new = np.full((len(nodes), 4 * M), -1, np.int64)
        new[np.searchsorted(nodes, target[keep]), place[keep]] = source[keep]
        both = np.concatenate([self.layers[nodes, layer].astype(np.int64), new], axis=1)
        self.layers[nodes, layer] = self._pick(nodes, both, 2 * M)

    def _pick(self, rows: np.ndarray, candidates: np.ndarray, m: int) -> np.ndarray:
        """Up to ``m`` neighbours, nearest first, none nearer to one picked before; then the nearest passed over."""
        out = np.full((len(rows), m), -1, np.int64)
        for at in range(0, len(rows), BLOCK):
            out[at : at + BLOCK] = self._pick_block(rows[at : at + BLOCK], candidates[at : at + BLOCK], m)
        return out

    def _pick_block(self, rows: np.ndarray, candidates: np.ndarray, m: int) -> np.ndarray:
        sims = (self.x[np.maximum(candidates, 0)] @ self.x[rows][:, :, None])[:, :, 0]
        sims[(candidates < 0) | (candidates == rows[:, None])] = -9
        order = np.argsort(candidates, axis=1, kind="stable")
        ordered = np.take_along_axis(candidates, order, axis=1)
        twice = np.zeros_like(ordered, bool)
        twice[:, 1:] = ordered[:, 1:] == ordered[:, :-1]
        np.put_along_axis(sims, order, np.where(twice, -9, np.take_along_axis(sims, order, axis=1)), axis=1)
        order = np.argsort(-sims, axis=1)[:, : 3 * m]
        candidates, sims = np.take_along_axis(candidates, order, axis=1), np.take_along_axis(sims, order, axis=1)
        picked = np.zeros(sims.shape, bool)
        near = self.x[np.maximum(candidates, 0)]
        between = near @ near.transpose(0, 2, 1)
        for k in range(sims.shape[1]):
            apart = ~(picked[:, :k] & (between[:, k, :k] > sims[:, k : k + 1])).any(axis=1) if k else True
            picked[:, k] = apart & (sims[:, k] > -9) & (picked.sum(axis=1) < m)
        rank = np.argsort(np.where(sims <= -9, 2, ~picked), axis=1, kind="stable")[:, :m]
        best, good = np.take_along_axis(candidates, rank, axis=1), np.take_along_axis(sims, rank, axis=1) > -9
        out = np.full((len(rows), m), -1, np.int64)
        out[:, : best.shape[1]] = np.where(good, best, -1)
        return out

    def _walk(self, queries: np.ndarray, starts: np.ndarray, layer: int, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Beam search on one layer for all queries at once; ids (-1: none) and similarities, best first."""
        q, n = len(queries), len(self.x)
        seen = np.zeros((q, n + 1), bool)
        seen[:, n] = True  # stands for no neighbour
        ids = np.full((q, beam), -1, np.int64)
        sims = np.full((q, beam), -9, np.float32)
        done = np.ones((q, beam), bool)

        def join(active: np.ndarray, new: np.ndarray) -> None:
            new = np.sort(np.where(new < 0, n, new), axis=1)
            fresh = ~seen[active[:, None], new]
            fresh[:, 1:] &= new[:, 1:] != new[:, :-1]
            seen[active[:, None], new] = True
            value = (self.x[np.minimum(new, n - 1)] @ queries[active][:, :, None])[:, :, 0]
            value[~fresh] = -9
            all_ids = np.concatenate([ids[active], new], axis=1)
            all_sims = np.concatenate([sims[active], value], axis=1)
            all_done = np.concatenate([done[active], ~fresh], axis=1)
            order = np.argsort(-all_sims, axis=1, kind="stable")[:, :beam]
            take = lambda a: np.take_along_axis(a, order, axis=1)
            sims[active], done[active] = take(all_sims), take(all_done)
            ids[active] = np.where(sims[active] > -9, take(all_ids), -1)

        join(np.arange(q), starts)
        while True:
            open_ = ~done
            active = np.flatnonzero(open_.any(axis=1))
            if not len(active):
                return ids, sims
            order = np.argsort(done[active], axis=1, kind="stable")[:, :EXPAND]  # the best that are open
            chosen = np.where(np.take_along_axis(done[active], order, axis=1), -1, np.take_along_axis(ids[active], order, axis=1))
            np.put_along_axis(tmp := done[active], order, True, axis=1)
            done[active] = tmp
            near = self.layers[np.maximum(chosen, 0), layer]
            near = np.where(chosen[:, :, None] >= 0, near, -1).reshape(len(active), -1)
            join(active, near)

    def search(self, queries: np.ndarray, beam: int) -> list[np.ndarray]:
        """Places of the vectors that may be similar to each query."""
        out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(queries)
        queries, waiting = queries.astype(np.float32), np.arange(len(queries))
        loose = np.float32(SIMILAR - 1e-3)
        while len(waiting):
            again = []
            step = max(16, min(BLOCK, (1 << 24) // max(len(self.x), 64 * beam)))
            for at in range(0, len(waiting), step):
                block = waiting[at : at + step]
                if beam >= len(self.x):
                    sims = queries[block] @ self.x.T
                    for row, query in enumerate(block):
                        out[query] = np.flatnonzero(sims[row] >= loose)
                    continue
                starts = np.repeat(self.entries[None, :], len(block), axis=0)
                for layer in range(self.top, 0, -1):
                    starts = self._walk(queries[block], starts, layer, 16)[0][:, :8]
                ids, sims = self._walk(queries[block], starts, 0, beam)
                full = (sims[:, -1] >= loose) & (ids[:, -1] >= 0)
                again.append(block[full])
                for row in np.flatnonzero(~full):
                    out[block[row]] = ids[row][sims[row] >= loose]
            waiting = np.concatenate(again) if again else waiting[:0]
            beam *= 4
        return out

    def audited(self, queries: np.ndarray) -> int:
        """A beam with which sampled queries find what a scan of the shard finds."""
        sample = queries[:: max(1, len(queries) // AUDIT)][:AUDIT].astype(np.float32)
        # Queries may have no neighbour here; copies of vectors of the shard, moved a little, have one at least.
        rng = np.random.default_rng(7)
        moved = self.x[rng.integers(0, len(self.x), AUDIT)]
        aside = rng.standard_normal(moved.shape).astype(np.float32)
        aside -= (aside * moved).sum(axis=1, keepdims=True) * moved
        aside /= np.maximum(np.linalg.norm(aside, axis=1, keepdims=True), 1e-9)
        cosine = rng.uniform(SIMILAR + 0.01, 1, (len(moved), 1)).astype(np.float32)
        sample = np.concatenate([sample, cosine * moved + np.sqrt(1 - cosine * cosine) * aside])
        sims = sample @ self.x.T
        similar = sims >= SIMILAR
        beam = BEAM
        while beam < len(self.x):
            found = self.search(sample, beam)
            hit = sum(int(similar[k][f].sum()) for k, f in enumerate(found))
            starts = np.repeat(self.entries[None, :], len(sample), axis=0)
            for layer in range(self.top, 0, -1):
                starts = self._walk(sample, starts, layer, 16)[0][:, :8]
            best = self._walk(sample, starts, 0, beam)[1][:, 0]
            nearest = (best >= sims.max(axis=1) - 1e-5).mean()
            if hit >= RECALL * similar.sum() and nearest >= NEAREST:
                break
            beam *= 2
        return beam


def usable(vectors: DataFrame) -> DataFrame:
    """``(vec_id, dim, vec)`` of the vectors that can link, as unit vectors in double precision."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, dims, data = [], [], []
            column = batch.column(1)
            values = column.values.to_numpy(zero_copy_only=False).astype(np.float64)
            offsets = column.offsets.to_numpy()
            for k, vec_id in enumerate(batch.column(0).to_pylist()):
                x = values[offsets[k] : offsets[k + 1]]
                top = np.abs(x).max() if len(x) and column[k].is_valid else 0.0
                if not top > 0 or not np.isfinite(top):  # a null component is not a number here
                    continue
                x = x / top  # no overflow in the norm
                ids.append(vec_id)
                dims.append(len(x))
                data.append((x / np.sqrt(x @ x)).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(dims, pa.int32()), pa.array(data, pa.binary())], ["vec_id", "dim", "vec"])

    return vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")).mapInArrow(run, VECTOR)


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    return np.stack([np.frombuffer(x.as_buffer()) for x in column])


def _build(table: pa.Table) -> pa.Table:
    table = table.sort_by("vec_id")
    graph = Graph(_matrix(table.column("vec")))
    # A vector has links on its own layers only.
    layers = pa.array([x[: top + 1].tobytes() for x, top in zip(graph.layers, graph.level.tolist(), strict=True)], pa.binary())
    return pa.table(
        {
            "dim": table.column("dim"),
            "shard": table.column("shard"),
            "place": pa.array(np.arange(len(table), dtype=np.int32)),
            "vec_id": table.column("vec_id"),
            "copies": table.column("copies"),
            "vec": table.column("vec"),
            "layers": layers,
        }
    )


def _find(nodes: pa.Table, queries: pa.Table) -> pa.Table:
    empty = pa.table({"vec_id": pa.array([], pa.int64()), "links": pa.array([], pa.int64()), "root": pa.array([], pa.int64())})
    if not len(nodes) or not len(queries):
        return empty
    nodes = nodes.sort_by("place")
    vectors, asked = _matrix(nodes.column("vec")), _matrix(queries.column("vec"))
    layers = np.full((len(nodes), 4, 2 * M), -1, np.int32)
    for k, x in enumerate(nodes.column("layers")):
        own = np.frombuffer(x.as_buffer(), np.int32).reshape(-1, 2 * M)
        layers[k, : len(own)] = own
    graph = Graph(vectors, layers)
    ids, copies, query_ids = (t.column(c).to_numpy() for t, c in ((nodes, "vec_id"), (nodes, "copies"), (queries, "vec_id")))
    links = np.zeros(len(asked), np.int64)
    parent: dict[int, int] = {}

    def root(v: int) -> int:
        while parent.setdefault(v, v) != v:
            parent[v] = parent[parent[v]]
            v = parent[v]
        return v

    for k, found in enumerate(graph.search(asked, graph.audited(asked))):
        found = found[ids[found] != query_ids[k]]
        found = found[vectors[found] @ asked[k] >= SIMILAR]
        links[k] = copies[found].sum()
        for other in ids[found].tolist():
            a, b = root(int(query_ids[k])), root(other)
            if a != b:
                parent[max(a, b)] = min(a, b)
    count = dict(zip(query_ids.tolist(), links.tolist(), strict=True))
    touched = sorted(parent.keys() | {q for q, n in count.items() if n})
    return pa.table(
        {
            "vec_id": pa.array(touched, pa.int64()),
            "links": pa.array([count.get(v, 0) for v in touched], pa.int64()),
            "root": pa.array([root(v) for v in touched], pa.int64()),
        }
    )


def slices(distinct: DataFrame, shards: int | None = None, parts: int | None = None) -> DataFrame:
    """``(dim, shards, parts)``: into how many slices the vectors of each dimension go."""
    links = 4 * 2 * M * 4  # bytes of a vector's links
    size = F.col("dim").cast("long") * 8
    cut = lambda given, row, most, least: F.lit(given) if given else F.greatest(F.lit(least), F.ceil(F.col("n") * row / most))
    counts = distinct.groupBy("dim").agg(F.count(F.lit(1)).alias("n"))
    return counts.select("dim", cut(shards, size + links, SHARD_BYTES, SHARDS).cast("int").alias("shards"), cut(parts, size, PART_BYTES, PARTS).cast("int").alias("parts"))


def near_vectors(vectors: DataFrame, shards: int | None = None, parts: int | None = None) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, one row per input row.

    ``vectors`` needs ``vec_id`` and ``embedding``; other columns are ignored. Vectors
    that are null, empty, zero or hold null or non-finite components, and vectors of
    different lengths, link with nothing. ``shards`` and ``parts`` replace the numbers
    that follow from the table. Rows repeated under one id are vectors of
    their own that share the id. ``component_id`` is the smallest id reachable.
    """
    own = stage(usable(vectors), "vectors")
    # Two hashes name a vector; rounding in the norm keeps scaled copies apart, which then link like any near copy.
    named = own.select("vec_id", "dim", "vec", F.xxhash64("vec").alias("h1"), F.xxhash64("vec", F.lit(1)).alias("h2"))
    groups = named.groupBy("h1", "h2").agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("copies"))
    firsts = named.groupBy("h1", "h2").agg(F.min("vec_id").alias("vec_id"), F.count(F.lit(1)).alias("copies"), F.first("dim").alias("dim"), F.first("vec").alias("vec"))
    firsts = stage(firsts, "distinct")
    cuts = stage(slices(firsts, shards, parts), "slices")
    firsts = firsts.join(cuts, "dim")
    firsts = firsts.withColumn("shard", F.pmod(F.xxhash64("h1", F.lit("shard")), F.col("shards")).cast("int"))
    nodes = stage(firsts.select("dim", "shard", "vec_id", "copies", "vec").groupBy("dim", "shard").applyInArrow(_build, NODE), "graphs")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    indexes = nodes.join(cuts.select("dim", "parts"), "dim").withColumn("part", each("parts")).drop("parts")
    part = F.pmod(F.xxhash64("h1", F.lit("part")), F.col("parts")).cast("int").alias("part")
    asked = firsts.select("dim", "vec_id", "vec", part, each("shards").alias("shard"))
    keys = ("dim", "shard", "part")
    found = stage(indexes.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(_find, LINKED), "found")
    roots = connected_components(found, "vec_id", "root").select(F.col("node").alias("first"), "component")
    counts = found.groupBy(F.col("vec_id").alias("first")).agg(F.sum("links").alias("links"))
    of_group = (
        groups.join(counts, "first", "left")
        .join(roots, "first", "left")
        .select("h1", "h2", "copies", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "first").alias("component"))
    )
    members = named.join(of_group, ["h1", "h2"]).select("vec_id", (F.col("links") + F.col("copies") - 1).alias("n_links"), "component")
    rest = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e"))
    unfit = F.col("e").isNull() | (F.size("e") == 0) | F.exists("e", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) | F.forall("e", lambda x: x == 0)
    alone = rest.where(unfit).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component"))
    return members.union(alone).select("vec_id", F.col("n_links").cast("long"), F.col("component").alias("component_id"), (F.col("vec_id") == F.col("component")).alias("kept"))
