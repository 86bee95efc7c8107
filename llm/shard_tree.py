"""Placing rows on shards by a hierarchical weighted hash tree.

A row descends from region to rack to shard. At each level every child draws
``-ln(u) / weight`` with ``u`` uniform from a hash of the row's key and the child's
name, and the least draw wins, so a child wins in proportion to its weight. A
draw depends on nothing but key, name and weight: when weights change, a row moves
only into a subtree that grew or out of one that shrank.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from llm.shared import numbered, stage

OVERHEAD = 16
NO_KEY = "none"


@dataclass(frozen=True)
class Leaf:
    """A shard, where it stands and its weight."""

    shard: int
    region: str
    rack: str
    weight: float = 1.0


def layout(shards: int, regions: int = 4, racks: int = 2) -> list[Leaf]:
    """``shards`` shards of equal weight over equal racks; any over a multiple get a region each.

    A shard that comes on top of a full layout is a region of its own: the only
    subtree that grows is that shard, so rows move into it and nowhere else.
    """
    per_rack = max(1, shards // (regions * racks))
    full = per_rack * regions * racks
    leaves = []
    for shard in range(shards):
        place = shard // per_rack
        region, rack = (f"region-{place // racks}", f"rack-{place % racks}") if shard < full else (f"region-x{shard}", "rack-0")
        leaves.append(Leaf(shard, region, rack))
    return leaves


def grown(leaves: list[Leaf], weight: float = 1.0) -> list[Leaf]:
    """The same tree with one more shard, as a region of its own."""
    shard = max(leaf.shard for leaf in leaves) + 1
    return [*leaves, Leaf(shard, f"region-x{shard}", "rack-0", weight)]


def _winner(key: Column, children: dict[str, float]) -> Column:
    """The name of the child with the least draw; ties go to the first name."""
    draws = []
    for name, weight in sorted(children.items()):
        # 53 bits of the hash, centred, give a double strictly between 0 and 1.
        hashed = F.shiftrightunsigned(F.xxhash64(key, F.lit(name)), 11)
        draws.append(F.struct((-F.log((hashed + F.lit(0.5)) / F.lit(float(1 << 53))) / F.lit(weight)).alias("d"), F.lit(name).alias("c")))
    return F.array_min(F.array(*draws))["c"] if len(draws) > 1 else F.lit(next(iter(children)))


def _choice(value: Column, branches: dict[str, Column]) -> Column:
    out = None
    for name, result in branches.items():
        out = F.when(value == name, result) if out is None else out.when(value == name, result)
    return out


def assign(docs: DataFrame, leaves: list[Leaf], name: str, key: str = "doc_id") -> DataFrame:
    """``docs`` with the number of each row's shard; a null key is one key of its own."""
    if not leaves or any(leaf.weight <= 0 for leaf in leaves):
        raise ValueError("a tree needs shards of positive weight")
    regions: dict[str, dict[str, dict[str, float]]] = {}
    for leaf in leaves:
        regions.setdefault(leaf.region, {}).setdefault(f"{leaf.region}/{leaf.rack}", {})[
            f"{leaf.region}/{leaf.rack}/{leaf.shard}"
        ] = leaf.weight
    text = F.coalesce(F.col(key).cast("string"), F.lit(NO_KEY))
    weight = lambda racks: sum(sum(x.values()) for x in racks.values())
    region = _winner(text, {r: weight(racks) for r, racks in regions.items()})
    rack = _choice(
        F.col("_region"), {r: _winner(text, {k: sum(x.values()) for k, x in racks.items()}) for r, racks in regions.items()}
    )
    leaf = _choice(F.col("_rack"), {k: _winner(text, x) for racks in regions.values() for k, x in racks.items()})
    return (
        docs.withColumn("_region", region)
        .withColumn("_rack", rack)
        .withColumn(name, F.substring_index(leaf, "/", -1).cast("int"))
        .drop("_region", "_rack")
    )


def shard_documents(docs: DataFrame, leaves: list[Leaf]) -> DataFrame:
    """One row per input row: its size, shard, slot in the shard, and shard once the tree has grown by one.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. A null text has
    no bytes; its checksum is that of the empty text. Repeated rows share a shard and
    get slots of their own. Slots have no gaps and follow no meaning but the hash.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    placed = assign(assign(rows, leaves, "shard"), grown(leaves), "grown_shard")
    placed = stage(placed, "shards")
    slotted = numbered(placed, ["shard"], ["doc_id", "text_crc32", "size"], "slot", placed.count())
    return slotted.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), "grown_shard"
    )
