"""Benchmark passages in documents: SimHash of item-sized windows, multi-index Hamming search, exact check.

Every benchmark item has two 128-bit SimHashes of its word shingles, one plain and one
weighted. A window of a document as long as an item gets both likewise. Fingerprints are cut
into ``BLOCKS`` blocks of 32 bits; two of them within ``RADIUS`` bits have a block within
``RADIUS // BLOCKS`` bits, and few unrelated ones do; of those that have, the Hamming distance
of the whole decides. What is left is checked by the exact Jaccard similarity of the two
shingle multisets, plain and weighted: a window is reported if either is enough.

By weight a shingle counts one over the number of items that hold it, counted over the whole
benchmark, so phrases common to many items count for little; where items share text, an edit
that no item holds would outweigh all of it, and the plain similarity finds the copy. Windows
without any shingle of an item of their size have similarity 0 and are not fingerprinted. An
item of fewer than five words is one shingle as a whole, and a window equals it or not.

A benchmark too large for one task goes in slices, one pass each. Counts of shingles that
several items share go to every slice, so results do not depend on how it is cut.
"""

from __future__ import annotations

import functools
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from llm.shared import free_name, stage, total_bytes
from llm.words import SHINGLE, Hasher, mix, pieces, shingles

SIMILARITY = 0.75
RADIUS = 37
BLOCKS = 4
PAIRS = 1 << 21
#: Bytes of benchmark text sent to tasks at once; a larger benchmark goes in slices, one pass each.
SLICE_BYTES = 16 << 20

FOUND = "doc_id long, item_id long, start_word long, n_words long, hamming int, similarity double"


Shared = tuple[np.ndarray, np.ndarray]  # sorted hashes of shingles that several items hold, and by how many
Sent = tuple[list[tuple[int, str]], Shared]


def _signs(hashes: np.ndarray) -> np.ndarray:
    """128 bits of each hash as -1 or 1."""
    both = np.stack([hashes, mix(hashes ^ np.uint64(0xA0761D6478BD642F))], axis=1)
    bits = np.unpackbits(both.astype("<u8").view(np.uint8).reshape(-1, 16), axis=1, bitorder="little")
    return bits.astype(np.float64) * 2 - 1


def _pack(sums: np.ndarray) -> np.ndarray:
    """Fingerprints as ``BLOCKS`` values of 32 bits."""
    return np.packbits(sums > 0, axis=1, bitorder="little").view("<u4").reshape(-1, BLOCKS)


class Benchmark:
    """The items of one slice, ready to be searched for."""

    def __init__(self, items: list[tuple[int, str]], shared: Shared) -> None:
        words, bounds = Hasher().words(pa.array([t for _, t in items], pa.string()))
        self.ids = [i for i, _ in items]
        self.lengths = np.diff(bounds)
        self.shared = shared
        runs = [shingles(words[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        self.counts = [np.unique(run, return_counts=True) for run in runs]
        self.holders: dict[int, dict[int, list[int]]] = defaultdict(dict)  # shingle -> length -> items
        for k, (found, _) in enumerate(self.counts):
            for h in found.tolist():
                self.holders[h].setdefault(int(self.lengths[k]), []).append(k)
        self.widths = sorted({int(min(n, SHINGLE)) for n in self.lengths if n})
        self.known = np.array(sorted(self.holders), np.uint64)
        #: Where no items share a shingle both ways are the same.
        self.ways = (False, True) if len(shared[0]) else (False,)
        self.prints = {plain: np.zeros((len(items), BLOCKS), np.uint32) for plain in self.ways}
        for k, run in enumerate(runs):
            for plain in self.ways if len(run) else ():
                self.prints[plain][k] = self.fingerprints(run, len(run), plain)[0]

    def weights(self, hashes: np.ndarray) -> np.ndarray:
        """One over the number of items that hold a shingle; 1 where none does."""
        keys, counts = self.shared
        out = np.ones(len(hashes))
        if len(keys):
            at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
            hit = keys[at] == hashes
            out[hit] = 1.0 / counts[at[hit]]
        return out

    def fingerprints(self, run: np.ndarray, width: int, plain: bool = False) -> np.ndarray:
        """SimHash of every stretch of ``width`` shingles of ``run``, by weight or plain."""
        signs = _signs(run)
        if not plain:
            signs *= self.weights(run)[:, None]
        total = np.concatenate([np.zeros((1, 128)), np.cumsum(signs, axis=0)])
        return _pack(total[width:] - total[:-width])

    def near(self, prints: np.ndarray, items: np.ndarray, plain: bool = False) -> Iterator[tuple[int, int, int]]:
        """``(print, item, distance)`` for all of ``items`` within the radius of each print."""
        theirs = self.prints[plain][items]
        step = max(1, PAIRS // len(items))
        for at in range(0, len(prints), step):
            ours = prints[at : at + step]
            met = np.zeros((len(ours), len(items)), bool)
            for b in range(BLOCKS):
                met |= np.bitwise_count(ours[:, b, None] ^ theirs[None, :, b]) <= RADIUS // BLOCKS
            p, k = np.nonzero(met)
            apart = np.bitwise_count(ours[p] ^ theirs[k]).sum(axis=1, dtype=np.int64)
            close = apart <= RADIUS
            yield from zip((p[close] + at).tolist(), items[k[close]].tolist(), apart[close].tolist(), strict=True)

    def similarity(self, run: np.ndarray, item: int) -> float:
        """The larger of the plain and the weighted Jaccard similarity of two shingle multisets."""
        ours, n = np.unique(run, return_counts=True)
        theirs, m = self.counts[item]
        every = np.union1d(ours, theirs)
        a, b = np.zeros((2, len(every)))
        a[np.searchsorted(every, ours)], b[np.searchsorted(every, theirs)] = n, m
        less, more, weight = np.minimum(a, b), np.maximum(a, b), self.weights(every)
        return float(max((weight * less).sum() / (weight * more).sum(), less.sum() / more.sum())) if len(every) else 0.0

    def search(self, words: np.ndarray, run: np.ndarray, hits: np.ndarray, width: int) -> dict[int, tuple]:
        """item -> (similarity, -hamming, -start) of its best window; ``hits`` are places of known shingles."""
        best: dict[int, tuple] = {}
        places: dict[int, list[np.ndarray]] = defaultdict(list)  # by item length
        wanted: dict[int, set[int]] = defaultdict(set)
        order = np.argsort(run[hits], kind="stable")
        found, starts = np.unique(run[hits][order], return_index=True)
        for h, at in zip(found.tolist(), np.split(hits[order], starts[1:]), strict=True):
            for n, items in self.holders[h].items():
                if min(n, SHINGLE) == width:
                    places[n].append(at)
                    wanted[n].update(items)
        for n, parts in places.items():
            items = np.array(sorted(wanted[n]))
            size = min(n, len(words)) - width + 1
            at, last = np.concatenate(parts), max(0, len(words) - n)
            # Every window that holds a hit starts in one of these stretches.
            steps = np.zeros(len(words) + 2, np.int64)
            np.add.at(steps, np.clip(at - (n - width), 0, last), 1)
            np.add.at(steps, np.minimum(at, last) + 1, -1)
            firsts = np.flatnonzero(np.cumsum(steps) > 0)
            for part in np.split(firsts, np.flatnonzero(np.diff(firsts) > 1) + 1):
                met: dict[tuple[int, int], int] = {}
                for plain in self.ways:
                    prints = self.fingerprints(run[part[0] : part[-1] + size], size, plain)
                    for p, item, apart in self.near(prints, items, plain):
                        met[p, item] = min(apart, met.get((p, item), apart))
                for (p, item), apart in met.items():
                    start = int(part[0]) + p
                    got = (self.similarity(run[start : start + size], item), -apart, -start)
                    if got[0] >= SIMILARITY and got > best.get(item, (0.0,)):
                        best[item] = got
        return best

    def rows(self, column: pa.Array, hasher: Hasher) -> Iterator[tuple[int, dict[int, tuple], int]]:
        """``(row, item -> best window, words)`` of the rows of ``column`` that hold any item."""
        first = 0
        for part in pieces(column):
            flat, bounds = hasher.words(part)
            for width in self.widths:
                every = shingles(flat, width) if len(flat) >= width else flat[:0]
                hits = np.flatnonzero(self.table[(every & np.uint64(len(self.table) - 1)).astype(np.int64)])
                hits = hits[np.isin(every[hits], self.known)]
                row = np.searchsorted(bounds, hits, "right") - 1
                inside = hits + width <= bounds[row + 1]
                hits, row = hits[inside], row[inside]
                for r in np.unique(row).tolist():
                    lo, hi = int(bounds[r]), int(bounds[r + 1])
                    best = self.search(flat[lo:hi], every[lo : hi - width + 1], hits[row == r] - lo, width)
                    if best:
                        yield first + r, best, hi - lo
            first += len(part)

    @functools.cached_property
    def table(self) -> np.ndarray:
        """Which low bits the shingles of items have; almost all others stop there."""
        out = np.zeros(1 << 22, bool)
        out[(self.known & np.uint64((1 << 22) - 1)).astype(np.int64)] = True
        return out


def _search(docs: DataFrame, slice_: Sent) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(slice_)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bench, hasher = Benchmark(*sent.value), Hasher()
        for batch in batches:
            ids = batch.column(0).to_pylist()
            rows = []
            for r, best, words in bench.rows(batch.column(1), hasher):
                for item, (similarity, apart, start) in best.items():
                    rows.append((ids[r], bench.ids[item], -start, min(int(bench.lengths[item]), words), -apart, similarity))
            columns = list(zip(*rows, strict=True)) or [()] * 6
            types = [pa.int64()] * 4 + [pa.int32(), pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                ["doc_id", "item_id", "start_word", "n_words", "hamming", "similarity"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, FOUND)


def shared_shingles(items: DataFrame) -> Shared:
    """The shingles that several items hold, over the whole benchmark."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for part in pieces(batch.column(0)):
                words, bounds = hasher.words(part)
                sets = [np.unique(shingles(words[a:b])) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sets).view(np.int64))], ["h"])

    counts = items.select("text").mapInArrow(run, "h long").groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").toPandas()
    keys = counts["h"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(keys)
    return keys[order], counts["n"].to_numpy(np.float64)[order]


def _slices(benchmark: DataFrame) -> Iterator[Sent]:
    """The items in slices of bounded size, each with the shingles that items share."""
    items = benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    items = stage(items, "benchmark")
    shared = shared_shingles(items)
    count = max(1, -(-total_bytes(items, "text") * 2 // SLICE_BYTES))
    for k in range(count):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == k)
        yield [(r["item_id"], r["text"]) for r in part.orderBy("item_id", "text").collect()], shared


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document row and item found in it: the best window and its similarity.

    ``docs`` needs ``doc_id`` and ``text``, ``benchmark`` ``item_id`` and ``text``; other
    columns are ignored. Null, empty and blank texts match nothing on either side.
    ``similarity`` is the larger of the plain and the weighted one, ``hamming`` the
    smaller distance of the two fingerprints. Of
    equally similar windows the nearest fingerprint, then the first, is given. Rows
    repeated in ``docs`` are reported as often; a document shorter than an item is
    one window.
    """
    out = None
    for slice_ in _slices(benchmark):
        found = _search(docs, slice_)
        out = found if out is None else out.union(found)
    return out


def flag(docs: DataFrame, benchmark: DataFrame, name: str) -> DataFrame:
    """``docs`` with a boolean ``name``: whether any item is in the row's text. Nothing is shuffled."""
    flagged = docs.withColumn(name, F.lit(False))
    for slice_ in _slices(benchmark):
        sent = docs.sparkSession.sparkContext.broadcast(slice_)
        flagged = flagged.withColumn(name, F.col(name) | _any_item(sent)("text"))
    return flagged


def _any_item(sent):
    @F.pandas_udf("boolean")
    def hit(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bench, hasher = Benchmark(*sent.value), Hasher()
        for texts in batches:
            out = np.zeros(len(texts), bool)
            for r, _, _ in bench.rows(pa.array(texts, pa.string(), from_pandas=True), hasher):
                out[r] = True
            yield pd.Series(out)

    return hit


def without_benchmark(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose texts hold no benchmark item, with all columns."""
    leak = free_name(docs, "leak")
    return flag(docs, benchmark, leak).where(~F.col(leak)).drop(leak)
