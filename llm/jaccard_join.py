"""Near-copy groups by exact Jaccard similarity of word shingles, found by a parity-sketch join.

Sketch. A text's distinct shingles are dealt by hash into ``k`` blocks, and each
block keeps the XOR of its shingles' hashes. Every shingle that only one of two
texts has changes one block, so the number of differing blocks bounds the
symmetric difference from below: texts whose sets differ in at most ``d`` shingles
agree on at least ``k - d`` blocks.

Join. ``100 * |A & B| >= 75 * |A | B|`` means ``|A ^ B| <= (|A| + |B|) / 7``, so
sizes lie within 3 : 4. Bands of set sizes overlap such that each pair of such
sizes shares a band; a band fixes ``k``, a little over the largest ``d`` in it.
Both sides then agree on one of their ``d + 1`` rarest blocks (the pigeonhole
principle under one global order, rarity). Block frequencies are counted over all
texts; blocks that many texts share, from a common passage say, are left out first.

Verify. Candidates of a block meet at the member that shares most blocks, and the exact set
similarity decides. Only blocks whose members are still in different components
are then compared within, by parity bits (one bit per shingle; their Hamming
distance is a lower bound as well), and again the exact similarity decides. Pairs
skipped are already connected, so no component misses a link.

Texts are named by a hash of id and text, so those without an id, or several under one,
are told apart. Equal sets are one node throughout, however many texts have them. Block entries
travel packed by slot, twelve bytes each; slots hold about ``SLOT_ENTRIES`` entries at any size.
Before shingle sets travel, sizes and parity bits refuse most candidates that are no links.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from llm.graph import connected_components
from llm.shared import discard, free_name, stage, total_bytes
from llm.words import Hasher, mix, pieces, shingle_sets

NUMERATOR, DENOMINATOR = 75, 100
SLOT_ENTRIES = 400_000
BYTES_PER_ENTRY = 9  # of text, measured on prose; only sets the number of slots
BAND_RATIO = 2.5
MAX_BITS = 1 << 16
#: Entries a task holds before it passes them on, bytes of shingle sets compared in one task, and rows of ids broadcast at most.
HELD_ENTRIES = 500_000
TASK_BYTES = 8 << 20
BROADCAST_ROWS = 2_000_000
BLOCK = 512

SIGNATURE = "doc_id long, row long, n_shingles long, node long, bits binary"
ENTRY = "slot int, entries binary"


def bands(largest: int) -> list[tuple[int, int]]:
    """Overlapping ranges of set sizes; each pair of sizes within 3 : 4 lies in one."""
    out, low = [], 3
    while low <= largest:
        high = max(low + 2, int(low * BAND_RATIO))
        out.append((low, high))
        low = NUMERATOR * high // DENOMINATOR + 1
    return out


def most_apart(total: int) -> int:
    """The largest symmetric difference of a link between sets of ``total`` shingles together."""
    return total * (DENOMINATOR - NUMERATOR) // (DENOMINATOR + NUMERATOR)


def blocks_of(high: int) -> int:
    """Blocks in a band: one more than differ at most, and an eighth that may be too common to use."""
    apart = most_apart(2 * high)
    return apart + 3 + apart // 8


def node_of(found: np.ndarray) -> int:
    """One 64-bit name for a set of shingles; never 0."""
    total = np.add.reduce(found) ^ np.uint64(len(found))
    folded = np.bitwise_xor.reduce(mix(found ^ np.uint64(0x5DEECE66D)))
    return int(mix(np.array([total ^ folded], np.uint64)).view(np.int64)[0]) or 1


def parity_bits(found: np.ndarray) -> bytes:
    """One bit per shingle, XORed into about eight bits a shingle."""
    width = 64
    while width < 8 * len(found) and width < MAX_BITS:
        width *= 2
    odd = np.bincount((found >> np.uint64(20)).astype(np.int64) % width, minlength=width) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def row_name() -> Column:
    """64 bits for a row's id and text; never null, and equal only for rows that repeat."""
    return F.xxhash64(F.col("doc_id").cast("long"), "text")


def signatures(docs: DataFrame) -> DataFrame:
    """Per row: its name, set size, node and parity bits; node is null for an empty set."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            sizes, nodes, bits = [], [], []
            for found in shingle_sets(batch.column(2), hasher):
                sizes.append(len(found))
                nodes.append(node_of(found) if len(found) else None)
                bits.append(parity_bits(found) if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()), pa.array(bits, pa.binary())],
                ["doc_id", "row", "n_shingles", "node", "bits"],
            )

    return docs.select(F.col("doc_id").cast("long"), row_name().alias("row"), "text").mapInArrow(run, SIGNATURE)


_ROW = np.dtype([("key", "<u4"), ("node", "<i8")])  # the key's last bit is the band's
_SIZE = np.dtype([("node", "<i8"), ("n", "<i8")])


def bands_of(n: int) -> Iterator[tuple[int, int, int]]:
    """``(band, blocks, spare)`` of a set of ``n`` shingles: spare blocks may be left out. Two bands at most, next to each other."""
    shape = bands(n)
    for b, (low, high) in enumerate(shape):
        if not low <= n <= high:
            continue
        if b + 1 < len(shape):  # only as the larger side: smaller partners that reach the next band meet there
            other = shape[b + 1][0] - 1
            if DENOMINATOR * other < NUMERATOR * n:
                continue
        else:
            other = min(high, DENOMINATOR * n // NUMERATOR)
        count = blocks_of(high)
        yield b, count, count - most_apart(n + other) - 1


def _blocks(found: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
    """Block digests of a set in each of its bands, with the band."""
    for b, count, _ in bands_of(len(found)):
        at = ((mix(found ^ np.uint64(b + 1)) >> np.uint64(32)) * np.uint64(count) >> np.uint64(32)).astype(np.int64)
        order = np.argsort(at, kind="stable")
        at, inside = at[order], found[order]
        starts = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
        digest = np.zeros(count, np.uint64)
        digest[at[starts]] = np.bitwise_xor.reduceat(inside, starts)
        yield mix(digest ^ mix(np.arange(count, dtype=np.uint64) + np.uint64((b + 1) << 40))), b


def packed_blocks(docs: DataFrame, slots: int) -> DataFrame:
    """All block entries, packed by slot as they come, each set once a task."""

    def pack(keys: list, rows: list) -> Iterator[pa.RecordBatch]:
        key = np.concatenate(keys)
        row = np.concatenate(rows)
        slot = ((key >> np.uint64(32)) % np.uint64(slots)).astype(np.int32)
        row["key"] |= (key & np.uint64(0xFFFFFFFE)).astype(np.uint32)
        yield _by_slot(slot, row, "entries")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, seen, keys, rows, held = Hasher(), set(), [], [], 0
        for batch in batches:
            for found in shingle_sets(batch.column(0), hasher):
                if len(found) < 3:  # nothing but an equal set is similar enough
                    continue
                node = node_of(found)
                if node in seen:
                    continue
                seen.add(node)
                for digests, band in _blocks(found):
                    row = np.empty(len(digests), _ROW)
                    row["node"], row["key"] = node, band & 1
                    keys.append(digests)
                    rows.append(row)
                    held += len(digests)
                if held > HELD_ENTRIES:
                    yield from pack(keys, rows)
                    keys, rows, held = [], [], 0
        if keys:
            yield from pack(keys, rows)

    return docs.select("text").mapInArrow(run, ENTRY)


def packed_sizes(members: DataFrame, slots: int) -> DataFrame:
    """``(slot, sizes)``: the size of each node, where its blocks will be."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            row = np.empty(len(batch), _SIZE)
            row["node"], row["n"] = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            row = np.unique(row)
            yield _by_slot((row["node"].copy().view(np.uint64) % np.uint64(slots)).astype(np.int32), row, "sizes")

    return members.select("node", "n_shingles").mapInArrow(run, "slot int, sizes binary")


def _by_slot(slot: np.ndarray, row: np.ndarray, name: str) -> pa.RecordBatch:
    """``row`` cut into one binary value a slot."""
    order = np.argsort(slot, kind="stable")
    slot, row = slot[order], row[order]
    starts = np.flatnonzero(np.append(len(slot) > 0, slot[1:] != slot[:-1]))
    ends = np.append(starts, len(slot))[1:]
    data = [row[a:z].tobytes() for a, z in zip(starts, ends, strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(slot[starts], pa.int32()), pa.array(data, pa.binary())], ["slot", name])


def shared_blocks(entries: DataFrame, members: DataFrame, slots: int) -> DataFrame:
    """``(block, node, shared)``: of each set the blocks it has to be looked for in.

    Blocks that two or more sets share are counted and packed again by node; a node's
    most frequent ones go as far as its band allows. ``shared`` is the number of blocks
    the node shares with anyone.
    """
    shape = np.dtype([("block", "<i8"), ("node", "<i8"), ("count", "<u2")])

    def count(table: pa.Table) -> pa.Table:
        slot = table.column("slot")[0].as_py() if len(table) else 0
        row = np.concatenate([np.frombuffer(x.as_buffer(), _ROW) for x in table.column("entries")])
        row = row[np.lexsort((row["node"], row["key"]))]
        same_key = row["key"][1:] == row["key"][:-1]
        row = row[np.append(True, ~(same_key & (row["node"][1:] == row["node"][:-1])))]
        starts = np.flatnonzero(np.append(True, row["key"][1:] != row["key"][:-1]))
        counts = np.diff(np.append(starts, len(row)))
        keep = np.repeat(counts > 1, counts)
        out = np.empty(int(keep.sum()), shape)
        out["node"] = row["node"][keep]
        out["count"] = np.minimum(np.repeat(counts, counts)[keep], 65535)
        out["block"] = row["key"][keep].astype(np.int64) + (np.int64(slot) << np.int64(32))
        home = (out["node"].copy().view(np.uint64) % np.uint64(slots)).astype(np.int32)
        return pa.Table.from_batches([_by_slot(home, out, "entries")])

    def rarest(table: pa.Table) -> pa.Table:
        parts = [np.frombuffer(x.as_buffer(), shape) for x in table.column("entries") if x.is_valid]
        row = np.concatenate(parts) if parts else np.empty(0, shape)
        known = np.unique(np.concatenate([np.frombuffer(x.as_buffer(), _SIZE) for x in table.column("sizes") if x.is_valid] or [np.empty(0, _SIZE)]))
        band = row["block"] & 1
        row = row[np.lexsort((row["block"], row["count"], band, row["node"]))]
        band = row["block"] & 1
        starts = np.flatnonzero(np.append(len(row) > 0, (row["node"][1:] != row["node"][:-1]) | (band[1:] != band[:-1])))
        sizes = np.diff(np.append(starts, len(row)))
        spares: dict[int, dict[int, int]] = {}
        n = known["n"][np.searchsorted(known["node"], row["node"][starts])].tolist()
        for k in set(n):
            spares[k] = {b & 1: spare for b, _, spare in bands_of(k)}
        spare = np.array([spares[k][b] for k, b in zip(n, band[starts].tolist(), strict=True)], np.int64)
        place = np.arange(len(row)) - np.repeat(starts, sizes)
        keep = place < np.repeat(sizes - spare, sizes)
        weight = np.repeat(sizes, sizes)[keep].astype(np.int32)
        return pa.table({"block": pa.array(row["block"][keep]), "node": pa.array(row["node"][keep]), "shared": pa.array(weight)})

    counted = entries.groupBy("slot").applyInArrow(count, ENTRY).withColumn("sizes", F.lit(None).cast("binary"))
    sizes = packed_sizes(members, slots).select("slot", F.lit(None).cast("binary").alias("entries"), "sizes")
    return counted.union(sizes).groupBy("slot").applyInArrow(rarest, "block long, node long, shared int")


def _small(table: DataFrame) -> DataFrame:
    """A staged table of ids, sent to all tasks if it is small enough; Spark joins a larger one by shuffling."""
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def heads_of(members: DataFrame) -> DataFrame:
    """``(node, row, n_shingles)``: of each node one row that has it, with the size of its set.

    An aggregate first, so that a set which many texts have is one row before it is moved.
    """
    return stage(members.groupBy("node").agg(F.min("row").alias("row"), F.min("n_shingles").alias("n_shingles")), "heads")


def _one_each(table: DataFrame) -> DataFrame:
    """A staged table with one row a node; rows that repeat in the input may have left more."""
    rows, nodes = table.agg(F.count(F.lit(1)), F.count_distinct("node")).first()
    return table if rows == nodes else table.dropDuplicates(["node"])


def node_bits(chosen: DataFrame, members: DataFrame) -> DataFrame:
    """``(node, bits)`` of the chosen rows."""
    own = members.select("row", "bits").join(_small(chosen.select("node", "row")), "row")
    return _one_each(stage(own.select("node", "bits"), "bits"))


def screened(pairs: DataFrame, members: DataFrame, heads: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs whose sizes and parity bits allow a link, ``(x, y, m)`` with ``y``'s size, and their nodes' rows."""
    nodes = pairs.select(F.explode(F.array("x", "y")).alias("node")).distinct()
    chosen = stage(heads.join(nodes, "node", "left_semi"), "texts")
    size = chosen.select("node", "n_shingles")
    sized = pairs.join(size.toDF("x", "n"), "x").join(size.toDF("y", "m"), "y")
    sized = stage(sized.where(DENOMINATOR * F.least("n", "m") >= NUMERATOR * F.greatest("n", "m")), "pairs")
    bits = node_bits(chosen, members)
    both = sized.join(bits.toDF("x", "a"), "x").join(bits.toDF("y", "b"), "y").select("x", "y", "n", "m", "a", "b")

    def near(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(len(batch), bool)
            totals = batch.column(2).to_numpy() + batch.column(3).to_numpy()
            for k, (a, b) in enumerate(zip(batch.column(4), batch.column(5), strict=True)):
                a, b = np.frombuffer(a.as_buffer(), np.uint8), np.frombuffer(b.as_buffer(), np.uint8)
                width = min(len(a), len(b))
                apart = np.bitwise_xor.reduce(a.reshape(-1, width), axis=0) ^ np.bitwise_xor.reduce(b.reshape(-1, width), axis=0)
                keep[k] = int(np.bitwise_count(apart).sum()) <= most_apart(int(totals[k]))
            yield batch.select([0, 1, 3]).filter(pa.array(keep))

    return stage(both.mapInArrow(near, "x long, y long, m long"), "pairs"), chosen


def shingle_table(docs: DataFrame, nodes: DataFrame, chosen: DataFrame) -> DataFrame:
    """``(node, found)``: the sorted shingles of the named sets, from one text each."""
    rows = stage(chosen.join(nodes, "node", "left_semi").select("row"), "texts")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, seen = Hasher(), set()
        for batch in batches:
            new = []  # repeated rows have one set
            for row in batch.column(0).to_pylist():
                new.append(row not in seen)
                seen.add(row)
            for part in pieces(batch.column(1).filter(pa.array(new, pa.bool_())), 50):
                sets = list(shingle_sets(part, hasher))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([node_of(x) if len(x) else None for x in sets], pa.int64()),
                        pa.array([x.tobytes() for x in sets], pa.binary()),
                    ],
                    ["node", "found"],
                )

    texts = docs.select(row_name().alias("row"), "text").join(_small(rows), "row", "left_semi").select("row", "text")
    return _one_each(stage(texts.mapInArrow(run, "node long, found binary"), "shingles"))


def verified(pairs: DataFrame, docs: DataFrame, members: DataFrame, heads: DataFrame) -> DataFrame:
    """Those of the distinct ``(x, y)`` that are links by the exact similarity of their sets."""
    if not pairs.head(1):
        return pairs
    pairs, chosen = screened(pairs, members, heads)
    nodes = stage(pairs.select(F.explode(F.array("x", "y")).alias("node")).distinct(), "nodes")
    found = shingle_table(docs, nodes, chosen)
    # A centre with many or large partners is split; its set goes to each part.
    parts = F.greatest(F.lit(1), F.ceil(8 * F.sum("m") / TASK_BYTES)).cast("int")
    centres = stage(pairs.groupBy("x").agg(parts.alias("parts"), F.sum("m").alias("m")), "centres")
    total = int(centres.agg(F.sum("m")).first()[0] or 0)
    tasks = max(1, -(-8 * total // TASK_BYTES))
    part = lambda: F.pmod(F.xxhash64("x", "part"), F.lit(tasks)).cast("int").alias("task")
    right = stage(pairs.join(centres.select("x", "parts"), "x").withColumn("part", F.pmod(F.xxhash64("y"), F.col("parts")).cast("int")), "pairs")
    right = found.select(F.col("node").alias("y"), "found").join(_small(right), "y").select(part(), "x", "y", "found")
    left = stage(centres.select("x", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")), "centres")
    left = found.select(F.col("node").alias("x"), "found").join(_small(left), "x").select(part(), "x", F.lit(None).cast("long").alias("y"), "found")

    def check(table: pa.Table) -> pa.Table:
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("found")]
        xs, ys = table.column("x").to_pylist(), table.column("y").to_pylist()
        centre = {x: s for x, y, s in zip(xs, ys, sets, strict=True) if y is None}
        linked = []
        for x, y, theirs in zip(xs, ys, sets, strict=True):
            if y is None:
                continue
            ours = centre[x]
            shared = len(np.intersect1d(ours, theirs, assume_unique=True))
            if DENOMINATOR * shared >= NUMERATOR * (len(ours) + len(theirs) - shared):
                linked.append((x, y))
        return pa.table({"x": pa.array([a for a, _ in linked], pa.int64()), "y": pa.array([b for _, b in linked], pa.int64())})

    links = stage(left.union(right).groupBy("task").applyInArrow(check, "x long, y long"), "links")
    for table in (found, nodes):
        discard(table)
    return links


def pairs_within(blocks: DataFrame, members: DataFrame, heads: DataFrame, roots: DataFrame) -> DataFrame:
    """Candidates inside blocks whose members are in several components, filtered by parity bits."""
    placed = blocks.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    members_of = [F.bit_xor(F.xxhash64("node", F.lit(k))).alias(f"h{k}") for k in (0, 1)]
    mixed = placed.groupBy("block").agg(F.min("root").alias("a"), F.max("root").alias("b"), F.count(F.lit(1)).alias("size"), *members_of)
    # Texts that share a passage share many blocks: of blocks with the same members one is enough.
    mixed = mixed.where("a != b").groupBy("size", "h0", "h1").agg(F.min("block").alias("block"))
    # A large block is compared in squares of BLOCK by BLOCK rows.
    mixed = mixed.select("block", F.ceil(F.col("size") / BLOCK).cast("int").alias("sides"))
    met = stage(placed.join(mixed, "block"), "met")
    if not met.head(1):
        return met.select(F.col("node").alias("x"), F.col("node").alias("y"))
    chosen = stage(heads.join(met.select("node").distinct(), "node", "left_semi"), "texts")
    own = node_bits(chosen, members).join(chosen.select("node", F.col("n_shingles").alias("size")), "node")
    rows = met.join(own, "node").withColumn("side", F.pmod(F.xxhash64("node"), F.col("sides")).cast("int"))
    squares = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("sides") - 1))).select(
        "block", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"), "side", "node", "root", "size", "bits"
    )

    def compare(table: pa.Table) -> pa.Table:
        data = {c: table.column(c).to_numpy() for c in ("block", "i", "j", "side", "node", "root", "size")}
        bits = [np.frombuffer(x.as_buffer(), np.uint8) for x in table.column("bits")]
        order = np.lexsort((data["j"], data["i"], data["block"]))
        changes = np.zeros(len(order), bool)
        changes[:1] = True
        for c in ("block", "i", "j"):
            changes[1:] |= data[c][order][1:] != data[c][order][:-1]
        starts = np.flatnonzero(changes)
        got: set[tuple[int, int]] = set()
        for a, z in zip(starts, np.append(starts[1:], len(order)), strict=True):
            at = order[a:z]
            got.update(_within({c: v[at] for c, v in data.items()}, [bits[k] for k in at]))
        return pa.table({"x": pa.array([p[0] for p in got], pa.int64()), "y": pa.array([p[1] for p in got], pa.int64())})

    slots = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions")) * 8
    keyed = squares.withColumn("task", F.pmod(F.xxhash64("block", "i", "j"), F.lit(slots)))
    return keyed.groupBy("task").applyInArrow(compare, "x long, y long").distinct()


def _within(rows: dict[str, np.ndarray], bits: list[np.ndarray]) -> Iterator[tuple[int, int]]:
    width = min(len(b) for b in bits)
    folded = np.stack([np.bitwise_xor.reduce(b.reshape(-1, width), axis=0) for b in bits])
    left = np.flatnonzero(rows["side"] == rows["i"])
    right = np.flatnonzero(rows["side"] == rows["j"])
    theirs, their_size, their_root, their_node = folded[right], rows["size"][right], rows["root"][right], rows["node"][right]
    for k in left:
        total = rows["size"][k] + their_size
        far = np.bitwise_count(folded[k] ^ theirs).sum(axis=1, dtype=np.int64)
        fits = (their_root != rows["root"][k]) & (far <= most_apart(total)) & (their_node != rows["node"][k])
        fits &= DENOMINATOR * np.minimum(rows["size"][k], their_size) >= NUMERATOR * np.maximum(rows["size"][k], their_size)
        for other in their_node[fits]:
            yield (int(min(rows["node"][k], other)), int(max(rows["node"][k], other)))


def components(docs: DataFrame) -> DataFrame:
    """``(doc_id, row, n_shingles, root)``, one row per input row; ``root`` names a component, null without shingles."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    slots = max(16, total_bytes(docs, "text") // BYTES_PER_ENTRY // SLOT_ENTRIES)
    members = stage(signatures(docs), "signatures")
    filled = members.where("node IS NOT NULL")
    blocks = stage(shared_blocks(packed_blocks(docs, slots), filled, slots), "blocks")
    # The text that others were copied from keeps all its blocks, and is similar to more of them.
    centres = blocks.groupBy("block").agg(F.max(F.struct("shared", "node"))["node"].alias("x"))
    # A centre meets all others of its block here, so only the others are compared later.
    others = stage(blocks.join(centres, "block").where("node != x").select("block", "x", F.col("node").alias("y")), "blocks")
    first = stage(others.select("x", "y").distinct(), "pairs")
    heads = heads_of(filled)
    links = verified(first, docs, filled, heads)
    roots = stage(_roots(links), "roots")
    second = stage(pairs_within(others.select("block", F.col("y").alias("node")), filled, heads, roots).join(first, ["x", "y"], "left_anti"), "pairs")
    more = verified(second, docs, filled, heads)
    if more.head(1):
        roots = stage(_roots(links.union(more)), "roots")
    discard(blocks)
    columns = "doc_id", "row", "n_shingles"
    placed = filled.select(*columns, "node").join(roots, "node", "left").select(*columns, F.coalesce("root", "node").alias("root"))
    return placed.union(members.where("node IS NULL").select(*columns, F.col("node").alias("root")))


def jaccard_components(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_shingles, component_id)``, one row per input row.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored, whatever
    their names. Null, empty and blank texts have no shingles and are a component
    of their own, as are texts similar to no other. Repeated rows come back
    repeated. ``component_id`` is the smallest ``doc_id`` reachable by links.
    """
    found = stage(components(docs), "components")
    linked = found.where("root IS NOT NULL")
    # Texts alone in their component need no partner; the others' components are few.
    least = linked.groupBy("root").agg(F.min("doc_id").alias("smallest"), F.count(F.lit(1)).alias("n"))
    several = stage(least.where("n > 1").select("root", "smallest"), "smallest")
    named = linked.join(several, "root", "left").select("doc_id", "n_shingles", F.coalesce("smallest", "doc_id").alias("component_id"))
    return named.union(found.where("root IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))


def _roots(links: DataFrame) -> DataFrame:
    found = connected_components(links, "x", "y")
    return found.select("node", F.col("component").alias("root"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` without near copies: of each component the row of its smallest id.

    All columns are kept. Rows without an id come last: one of them stays where a
    component has no other. Texts under one id are told apart. Repeated rows are one
    row, except those that have neither an id nor words, which are nobody's copies.
    """
    found = stage(components(docs), "components")
    name, each = free_name(docs, "row"), free_name(docs, "each")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row"))["row"]
    kept = found.where("root IS NOT NULL").groupBy("root").agg(first.alias(name)).select(name, F.lit(False).alias(each))
    blank = found.where("root IS NULL").select(F.col("row").alias(name), F.col("doc_id").isNull().alias(each)).distinct()
    rows = docs.withColumn(name, row_name()).join(stage(kept.union(blank), "kept"), name)
    rows = rows.withColumn(each, F.when(F.col(each), F.monotonically_increasing_id()))
    return rows.dropDuplicates([name, "doc_id", each]).select(*docs.columns)
