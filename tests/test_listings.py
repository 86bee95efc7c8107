"""Ingest decisions against a walk over the listings."""

import random

import pytest
from pyspark.sql import functions as F

from threadloom.operators.listings import (
    Sort,
    assign_batches,
    classify,
    count_met,
    drop_seen,
    expand_sorts,
    first_wins,
    ingest_counts,
    listing_union,
    number_new,
    rows_met,
    seen_union,
)
from threadloom.operators.ordering import with_global_index

ROWS = "listing_rank int, pos long, id string, usable boolean"


def walk(rows, seen, limit):
    seen, new, skipped, failed = set(seen), [], 0, 0
    for rank, pos, name, usable in sorted(rows):
        if limit and len(new) >= limit:
            break
        if name is None or name in seen:
            skipped += 1
        elif usable:
            seen.add(name)
            new.append((name, rank, pos))
        else:
            failed += 1
    return new, skipped, failed


@pytest.mark.parametrize("seed", range(4))
def test_ingest_is_the_walk(spark, seed):
    rng = random.Random(seed)
    # One id holds a third of all rows.
    ids = ["hot"] * 12 + [None] + [f"p{i}" for i in range(24)]
    rows = [
        (rank, pos, rng.choice(ids), rng.random() > 0.3) for rank in range(4) for pos in range(40)
    ]
    seen = rng.sample([x for x in ids if x], 5)
    frame = spark.createDataFrame(rows, ROWS)
    ledger = spark.createDataFrame([(x,) for x in seen], "id string")
    for limit in (0, 1, 7, 10_000):
        new, skipped, failed = walk(rows, seen, limit)
        numbered = number_new(drop_seen(first_wins(frame), ledger), limit)
        taken = numbered.orderBy("n").collect()
        assert [(r.id, r.listing_rank, r.pos) for r in taken] == new
        assert [r.n for r in taken] == list(range(1, len(new) + 1))
        counts = ingest_counts(classify(rows_met(frame, numbered, limit), ledger), 3).first()
        assert tuple(counts) == (len(new), skipped, failed, len(new) + 3)


def test_a_malformed_post_leaves_its_id_open(spark):
    rows = [(0, 1, "a", False), (1, 1, "a", True), (2, 1, "a", True)]
    got = first_wins(spark.createDataFrame(rows, ROWS)).collect()
    assert [tuple(row) for row in got] == [("a", 1, 1)]


def test_batches(spark):
    numbered = spark.range(1, 6).select(F.col("id").alias("n"))
    got = assign_batches(numbered, 2, 3).orderBy("n").collect()
    assert [(r.batch_no, r.post_pos) for r in got] == [(3, 0), (3, 1), (4, 0), (4, 1), (5, 0)]
    with pytest.raises(ValueError):
        assign_batches(numbered, 0)


def test_listing_union_caps_and_ranks(spark, caplog):
    posts = spark.createDataFrame([(f"p{i}", i) for i in range(10)], "id string, score int")
    sorts = {
        "new": Sort(["score DESC"]),
        "top": Sort(["score"], {"few": F.col("score") < 2, "all": F.lit(True)}),
    }
    names = ("new", "odd", "top")
    assert [x[0] for x in expand_sorts(names, sorts)] == ["new", "top/few", "top/all"]
    assert "odd" in caplog.text
    got = listing_union(posts, sorts, names, items=3).orderBy("listing_rank", "pos").collect()
    assert [(r.listing, r.id, r.pos) for r in got] == [
        ("new", "p9", 1), ("new", "p8", 2), ("new", "p7", 3),
        ("top/few", "p0", 1), ("top/few", "p1", 2),
        ("top/all", "p0", 1), ("top/all", "p1", 2), ("top/all", "p2", 3),
    ]


def test_global_index_and_seen_union(spark):
    frame = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"))
    got = with_global_index(frame.repartition(5), ["k"], "n", first=10).collect()
    assert all(row.n == row.k + 10 for row in got)
    union = seen_union(frame.limit(3).select(F.lit("a").alias("id")), frame.select(F.lit("b").alias("id")))
    assert sorted(row.id for row in union.collect()) == ["a", "b"]


@pytest.mark.parametrize("seed", range(3))
def test_counts_join_early_rows_only(spark, seed):
    rng = random.Random(seed)
    rows = [(f"l{rank}", rank, pos, rng.choice([None, *(f"p{i}" for i in range(30))]), rng.choice([True, True, False, None])) for rank in range(3) for pos in range(40)]
    rows += rng.choices(rows, k=10)
    rows += [("l0", 0, 50, "bad", False), ("l2", 2, 50, "bad", None), ("l0", 0, None, "odd", True), ("l1", 1, None, "odd", False)]
    frame = spark.createDataFrame(rows, "listing string, listing_rank int, pos long, id string, usable boolean")
    ledger = spark.createDataFrame([("p3",), ("p4",), ("p3",), (None,)], "id string")
    assert count_met(frame, ledger, 5).collect() == ingest_counts(classify(frame, ledger), 5).select(*count_met(frame, ledger).columns).collect()
    none = frame.filter("not usable")
    assert tuple(count_met(none, ledger).first()) == tuple(ingest_counts(classify(none, ledger)).select(*count_met(none, ledger).columns).first())
    assert tuple(count_met(frame.limit(0), ledger, 2).first()) == (0, 0, 0, 2)
