"""Where rows go, that growth moves rows only into what grew, and slots."""

import math
import zlib

import xxhash

from llm.shard_tree import Leaf, assign, grown, layout, shard_documents


def placed(spark, leaves, n=4000):
    ids = spark.range(n).withColumnRenamed("id", "doc_id")
    return {r["doc_id"]: r["s"] for r in assign(ids, leaves, "s").collect()}


def test_weights_and_growth(spark):
    leaves = layout(16)
    before, after = placed(spark, leaves), placed(spark, grown(leaves))
    assert all(after[k] in (s, 16) for k, s in before.items())
    sizes = [list(before.values()).count(s) for s in range(16)]
    assert min(sizes) > 170 and max(sizes) < 340
    heavier = [Leaf(x.shard, x.region, x.rack, 3.0 if x.shard == 0 else 1.0) for x in leaves]
    moved = {k: s for k, s in placed(spark, heavier).items() if s != before[k]}
    region = {x.shard: x.region for x in leaves}
    assert moved and all(region[s] == region[0] for s in moved.values())  # only into the subtree that grew


def test_rows_sizes_and_slots(spark):
    rows = [(1, "é"), (1, "é"), (2, None), (3, ""), (None, "x"), (4, "y" * 100_000)]
    docs = spark.createDataFrame([(a, b, 7) for a, b in rows], "doc_id long, text string, shard int")
    found = shard_documents(docs, layout(40)).collect()
    assert sorted((r["size"], r["text_crc32"]) for r in found) == sorted((len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for _, t in rows)
    for shard in {r["shard"] for r in found}:
        slots = sorted(r["slot"] for r in found if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    assert len({r["shard"] for r in found if r["doc_id"] == 1}) == 1
    assert shard_documents(docs.limit(0), layout(40)).collect() == []


def descended(key, leaves):
    """The shard of a key, level by level, each child's draw by itself."""

    def draw(name, weight):
        h = xxhash.xxh64(name.encode(), xxhash.xxh64(key.encode(), 42).intdigest()).intdigest() >> 11
        return -math.log((h + 0.5) / (1 << 53)) / weight

    def least(weights):
        return min(sorted(weights), key=lambda name: draw(name, weights[name]))

    def summed(name_of, some):
        out = {}
        for x in some:
            out[name_of(x)] = out.get(name_of(x), 0.0) + x.weight
        return out

    region = least(summed(lambda x: x.region, leaves))
    inside = [x for x in leaves if x.region == region]
    rack = least(summed(lambda x: f"{x.region}/{x.rack}", inside))
    shards = [x for x in inside if f"{x.region}/{x.rack}" == rack]
    return int(least({f"{rack}/{x.shard}": x.weight for x in shards}).rsplit("/", 1)[1])


def test_every_row_against_a_descent_of_its_own(spark):
    uneven = [Leaf(x.shard, x.region, x.rack, 1.0 + x.shard % 5) for x in layout(40)]
    rows = [(k * 7919 - 3000,) for k in range(1500)] + [(None,)]
    ids = spark.createDataFrame(rows, "doc_id long")
    for leaves in (layout(40), grown(layout(40)), uneven, layout(3)):
        found = {r["doc_id"]: r["s"] for r in assign(ids, leaves, "s").collect()}
        assert found == {k: descended("none" if k is None else str(k), leaves) for (k,) in rows}
