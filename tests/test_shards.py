"""Shard packing against a post-by-post model."""

import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from threadloom.operators.shards import (
    Budget,
    OpenShard,
    Transition,
    assign_shards,
    attach_shards,
    pack,
    resume_shard,
    shard_ranges,
    shard_summary,
)


def one_by_one(sizes, shard, budget):
    file_no, held_b, held_w = shard.file_no, shard.bytes, shard.words
    numbers = []
    for b, w in sizes:
        full = held_b + b > budget.max_bytes or held_w + w > budget.max_words
        if held_b > 0 and full:
            file_no, held_b, held_w = file_no + 1, 0, 0
        numbers.append(file_no)
        held_b, held_w = held_b + b, held_w + w
    return numbers, (held_b, held_w, file_no)


posts = st.lists(st.tuples(st.integers(1, 40), st.integers(0, 12)), min_size=1, max_size=60)
budgets = st.builds(Budget, st.integers(1, 90), st.integers(1, 30))


def arrays(sizes):
    b, w = zip(*sizes)
    return np.array(b, dtype=np.int64), np.array(w, dtype=np.int64)


@settings(max_examples=300, deadline=None)
@given(posts, budgets, st.integers(0, 100), st.integers(0, 40))
def test_pack_follows_the_rule(sizes, budget, used_b, used_w):
    shard = OpenShard(3, used_b, used_w if used_b else 0)
    assert list(pack(*arrays(sizes), shard, budget)) == one_by_one(sizes, shard, budget)[0]


@settings(max_examples=300, deadline=None)
@given(st.lists(posts, min_size=1, max_size=5), budgets, st.integers(1, 100), st.integers(0, 40))
def test_transitions_compose(runs, budget, used_b, used_w):
    used_b, used_w = min(used_b, budget.max_bytes), min(used_w, budget.max_words)
    whole = Transition.of_posts(*arrays(runs[0]), budget)
    for run in runs[1:]:
        whole = whole.then(Transition.of_posts(*arrays(run), budget), budget)
    flat = [size for run in runs for size in run]
    state = one_by_one(flat, OpenShard(0, used_b, used_w), budget)[1]
    assert tuple(int(x) for x in whole.enter(used_b, used_w, budget)) == state


@pytest.mark.parametrize(
    "count,chunk_rows,fan_in,shard",
    [
        (400, 1000, 64, OpenShard()),
        (400, 37, 64, OpenShard()),
        (400, 11, 3, OpenShard()),
        (400, 11, 3, OpenShard(5, 700, 20)),
        (5, 1, 2, OpenShard()),
    ],
)
def test_assign_shards_in_chunks(spark, count, chunk_rows, fan_in, shard):
    rng = random.Random(count * chunk_rows)
    budget = Budget(1500, 90)
    rows = [
        (f"b{i // 40:03d}", i % 40, rng.choice([10, 90, 400, 2000]), rng.randint(0, 40))
        for i in range(count)
    ]
    sizes = spark.createDataFrame(rows, "file_name string, post_pos int, bytes long, words long")
    placed = assign_shards(
        sizes.repartition(4), ["file_name", "post_pos"], budget, shard, chunk_rows, fan_in
    )
    got = [r.file_no for r in placed.orderBy("file_name", "post_pos").collect()]
    assert got == one_by_one([row[2:] for row in rows], shard, budget)[0]
    attached = attach_shards(sizes, shard_ranges(placed)).orderBy("file_name", "post_pos")
    assert [r.file_no for r in attached.collect()] == got
    summary = shard_summary(placed, ["file_name", "post_pos"]).collect()
    assert sum(r.posts for r in summary) == count


def test_resume_needs_room_in_both_budgets(spark):
    def ledger(*rows):
        return spark.createDataFrame(list(rows), "file_no long, bytes long, words long")

    budget = Budget(100, 10)
    assert resume_shard(ledger(), budget) == OpenShard()
    assert resume_shard(ledger((1, 90, 9), (2, 40, 3), (2, 40, 3)), budget) == OpenShard(2, 80, 6)
    assert resume_shard(ledger((1, 100, 3)), budget) == OpenShard(2)
    assert resume_shard(ledger((1, 10, 10)), budget) == OpenShard(2)
