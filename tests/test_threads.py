"""Forests against plain recursion."""

import json
import random

import pytest
from pyspark.sql import functions as F

from threadloom.operators.threads import (
    AFTER_ALL,
    count_comments,
    flatten_adjacency,
    nest_tokens,
    prune_empty,
    with_paths,
)

ROWS = "post_id string, comment_id string, parent_id string, pos int, body string, usable boolean"


def grow(rng, post, size, hot):
    """Random forest; ``hot`` makes one comment the parent of most others."""
    rows, children = [], {}
    for i in range(size):
        parent = None if i == 0 else ("0" if hot and rng.random() < 0.7 else str(rng.randrange(i)))
        parent = None if i and rng.random() < 0.15 else parent
        pos = children.setdefault(parent, [])
        rows.append((post, str(i), parent, len(pos), rng.choice(["", "text"]), rng.random() > 0.1))
        pos.append(rows[-1])
    return rows, children


def visit(children, parent, path, cap):
    for row in children.get(parent, []):
        if row[5]:
            here = [*path, row[3]]
            yield row, here
            if len(here) <= cap:
                yield from visit(children, row[1], here, cap)


def shown(children, row):
    return row[4] != "" or any(shown(children, x) for x in children.get(row[1], []) if x[5])


@pytest.fixture(scope="module")
def forests():
    rng = random.Random(11)
    return {f"p{i}": grow(rng, f"p{i}", 40, i == 0) for i in range(6)}


@pytest.fixture(scope="module")
def comments(spark, forests):
    return spark.createDataFrame([row for rows, _ in forests.values() for row in rows], ROWS)


@pytest.mark.parametrize("cap", [0, 1, 3, 50])
def test_flatten(comments, forests, cap):
    got = {(r.post_id, r.comment_id): r.path for r in flatten_adjacency(comments, ["post_id"], cap).collect()}
    expected = {
        (post, row[1]): path
        for post, (_, children) in forests.items()
        for row, path in visit(children, None, [], cap)
    }
    assert got == expected


def test_prune_and_counts(comments, forests):
    placed = with_paths(comments, ["post_id"], 50)
    kept = prune_empty(placed, ["post_id"])
    expected = {
        (post, row[1])
        for post, (_, children) in forests.items()
        for row, _ in visit(children, None, [], 50)
        if shown(children, row)
    }
    assert {(r.post_id, r.comment_id) for r in kept.collect()} == expected
    for r in count_comments(placed, ["post_id"]).collect():
        reached = list(visit(forests[r.post_id][1], None, [], 50))
        assert r.comments == len(reached)
        assert r.top_level == sum(len(path) == 1 for _, path in reached)


def test_nested_json(comments, forests):
    placed = with_paths(comments, ["post_id"], 50)
    tokens = nest_tokens(placed, ["post_id"], F.to_json(F.struct(F.col("comment_id").alias("id"))))
    texts = {}
    for r in sorted(tokens.collect(), key=lambda r: (r.post_id, r.path)):
        texts.setdefault(r.post_id, []).append(r.token)

    def nested(children, parent):
        return [
            {"id": row[1], "replies": nested(children, row[1])}
            for row in children.get(parent, [])
            if row[5]
        ]

    for post, (_, children) in forests.items():
        assert json.loads("[" + "".join(texts[post]) + "]") == nested(children, None)
    assert AFTER_ALL == 2**31 - 1


def test_chains_thousands_deep_in_few_rounds(spark, monkeypatch):
    import threadloom.operators.threads as threads

    rounds, plain = [], threads.materialize
    monkeypatch.setattr(threads, "materialize", lambda df: rounds.append(1) or plain(df))
    depth = 3000
    rows = [("p", str(i), None if i == 0 else str(i - 1), i % 3, "", True) for i in range(depth)]
    got = flatten_adjacency(spark.createDataFrame(rows, ROWS), ["post_id"]).collect()
    paths = {int(r.comment_id): r.path for r in got}
    assert all(paths[i] == [k % 3 for k in range(i + 1)] for i in (0, 1, 2, 1023, 2999)) and len(paths) == depth
    assert len(rounds) <= 13


def test_circles_orphans_and_shared_ids(spark):
    rows = [
        # A circle of three with a tail, one that holds itself, and a reply to nobody.
        ("p", "a", "c", 0), ("p", "b", "a", 0), ("p", "c", "b", 0), ("p", "d", "a", 1), ("p", "e", "d", 0),
        ("p", "s", "s", 0), ("p", "t", "s", 0), ("p", "o", "nobody", 0), ("p", "o2", "o", 0),
        # Two comments share "x": the less deep one takes the replies, wherever the other stands.
        ("p", "r", None, 0), ("p", "q", "r", 0), ("p", "x", "q", 0), ("p", "x", "r", 5), ("p", "y", "x", 2), ("p", "z", "y", 1),
        # One of two that share "w" hangs below itself; "v" hangs below "w", and shares its id too.
        ("p", "w", "r", 7), ("p", "w", "v", 3), ("p", "v", "w", 4), ("p", "v", "z", 0), ("p", "u", "v", 9),
        # Replies of other posts do not mix; a comment without an id has no replies.
        ("n", "y", None, 1), ("n", None, "y", 0), ("n", "x", "y", 3),
    ]
    table = spark.createDataFrame([(*r, "", True) for r in rows], ROWS)
    got = sorted((r.post_id, r.comment_id or "", r.path) for r in flatten_adjacency(table, ["post_id"]).collect())
    assert got == sorted([
        ("p", "r", [0]), ("p", "q", [0, 0]), ("p", "x", [0, 0, 0]), ("p", "x", [0, 5]), ("p", "y", [0, 5, 2]), ("p", "z", [0, 5, 2, 1]),
        ("p", "w", [0, 7]), ("p", "v", [0, 7, 4]), ("p", "w", [0, 7, 4, 3]), ("p", "v", [0, 5, 2, 1, 0]), ("p", "u", [0, 7, 4, 9]),
        ("n", "y", [1]), ("n", "", [1, 0]), ("n", "x", [1, 3]),
    ])


def test_deep_chains_store_few_positions(spark, monkeypatch):
    import threadloom.operators.threads as threads

    stored, plain = [], threads.materialize

    def watched(df):
        kept = plain(df)
        if "path" in kept.columns:
            stored.append(kept.agg(F.sum(F.size("path"))).first()[0] or 0)
        return kept

    monkeypatch.setattr(threads, "materialize", watched)
    depth = 2000
    rows = [("p", str(i), None if i == 0 else str(i - 1), i % 3, "", True) for i in range(depth)]
    got = with_paths(spark.createDataFrame(rows, ROWS), ["post_id"]).agg(F.sum("depth"), F.max("path"), F.count("*")).first()
    assert tuple(got) == (depth * (depth - 1) // 2, [i % 3 for i in range(depth)], depth)
    assert max(stored) < depth * 200  # whole paths hold a thousand positions a row


def first_reached(rows):
    """(comment_id, path) level by level: of the comments of an id the first in order takes its replies."""
    below, claimed, level, found = {}, set(), [(None, [])], []
    for row in sorted(set(rows), key=lambda r: r[2]):
        below.setdefault(row[1], []).append(row)
    while level:
        level = [(row[0], [*path, row[2]]) for name, path in level for row in below.get(name, [])]
        level.sort(key=lambda x: x[1])
        found += level
        level = [x for x in level if x[0] is not None and x[0] not in claimed and not claimed.add(x[0])]
    return found


@pytest.mark.parametrize("every", [1, 2, 5])
def test_anchors_among_shared_ids_and_circles(spark, monkeypatch, every):
    import threadloom.operators.threads as threads

    monkeypatch.setattr(threads, "ANCHOR_EVERY", every)
    rng, rows = random.Random(every), []
    for i in range(160):
        parent = None if i % 40 == 0 else str(i - 1 if rng.random() < 0.8 else rng.randrange(i // 40 * 40, i))
        rows.append((str(i), parent, i))
    rows += [(str(rng.randrange(160)), str(rng.randrange(160)), 200 + i) for i in range(6)]
    rows += [("c0", "c2", 300), ("c1", "c0", 301), ("c2", "c1", 302), ("c3", "c1", 303), ("c4", "gone", 304), ("c5", "c4", 305)]
    table = spark.createDataFrame([("p", *row, "", True) for row in rows], ROWS)
    got = flatten_adjacency(table, ["post_id"]).collect()
    assert sorted((r.comment_id, r.path) for r in got) == sorted(first_reached(rows))
    capped = flatten_adjacency(table, ["post_id"], 7).collect()
    assert sorted((r.comment_id, r.path) for r in capped) == sorted(x for x in first_reached(rows) if len(x[1]) <= 8)
