"""The join against all pairs, and what holds for its sketches."""

import random

import numpy as np
import pytest

from llm.jaccard_join import bands, blocks_of, jaccard_components, most_apart, one_of_each, parity_bits
from llm.graph import connected_components


def brute(rows):
    sets = {}
    for k, (_, text) in enumerate(rows):
        w = (text or "").encode().lower().split()
        sets[k] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    least = {}
    for k, (doc_id, _) in enumerate(rows):
        least[root(k)] = min(least.get(root(k), doc_id), doc_id)
    return sorted((rows[k][0], len(sets[k]), least[root(k)]) for k in sets)


@pytest.fixture(scope="module")
def rows():
    r = random.Random(4)
    words = [f"w{k}" for k in range(60)]
    rows = [(1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "One  TWO"), (5, "one two"), (6, "one")]
    for g in range(12):
        base = [r.choice(words) for _ in range(r.choice([5, 6, 7, 8, 12, 30, 80, 300]))]
        for _ in range(r.choice([1, 2, 6, 25])):
            text = list(base)
            for _ in range(r.randint(0, max(1, len(base) // 40))):
                at = r.randrange(len(text))
                text[at : at + r.choice([0, 1])] = [r.choice(words)]
            rows.append((100 + len(rows), " ".join(text)))
    r.shuffle(rows)
    return rows


def test_components_are_those_of_all_pairs(spark, rows):
    docs = spark.createDataFrame([(a, b, a, "x") for a, b in rows], "doc_id long, text string, node long, bits string")
    found = sorted(tuple(r) for r in jaccard_components(docs.repartition(3)).collect())
    assert found == brute(rows)


def test_one_document_of_each_group_stays(spark, rows):
    docs = spark.createDataFrame([(a, b, "k") for a, b in rows], "doc_id long, text string, component_id string")
    kept = one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for _, _, c in brute(rows)})


def test_texts_without_an_id_or_with_a_shared_one(spark):
    r = random.Random(8)
    new = lambda: [f"w{r.randrange(500)}" for _ in range(60)]
    edit = lambda text, at: " ".join([*text[:at], "changed", *text[at + 1 :]])
    clean, other, alone, group, nameless, bridge = (new() for _ in range(6))
    rows = [
        (None, " ".join(clean)),  # like nothing else
        (3, " ".join(other)),
        (5, " ".join(alone)),  # two texts under one id, one of them a near copy of 3
        (5, edit(other, 30)),
        (None, " ".join(group)),  # a near copy of 6 without an id
        (6, edit(group, 30)),
        *[(None, edit(nameless, k)) for k in (58, 59, 59)],  # a group without any id
        (8, edit(bridge, 58)),
        (None, " ".join(bridge)),  # connects 8 and 9
        (9, edit(bridge, 2)),
        (None, ""),
        (None, ""),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [tuple(x) for x in one_of_each(docs.repartition(3)).collect()]
    texts = {t for _, t in rows[6:9]}
    assert sum(t in texts for _, t in kept) == 1
    want = [rows[0], rows[1], rows[2], rows[5], rows[9], *rows[12:]]
    assert sorted((x for x in kept if x[1] not in texts), key=str) == sorted(want, key=str)
    found = [(x["doc_id"], x["component_id"]) for x in jaccard_components(docs).collect()]
    ids = [None, 3, 5, 3, 6, 6, None, None, None, 8, 8, 8, None, None]
    assert sorted(found, key=str) == sorted(((d, c) for (d, _), c in zip(rows, ids, strict=True)), key=str)


def test_documents_connected_by_a_text_without_an_id(spark):
    words = [f"v{k}" for k in range(100)]
    ends = (" ".join(words[:-12]), " ".join(words[12:]))  # similar to the whole, not to each other
    docs = spark.createDataFrame([(1, ends[0]), (None, " ".join(words)), (2, ends[1])], "doc_id long, text string")
    assert {r["component_id"] for r in jaccard_components(docs).collect()} == {1}
    assert [r["doc_id"] for r in one_of_each(docs).collect()] == [1]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard_components(docs).collect() == [] and one_of_each(docs).collect() == []


def test_every_pair_of_linkable_sizes_shares_a_band():
    shape = bands(4000)
    for a in range(3, 1500, 7):
        for b in {a, a * 4 // 3}:
            if 4 * a >= 3 * b:
                assert any(low <= a and b <= high for low, high in shape)
    assert all(blocks_of(high) > most_apart(2 * high) for _, high in shape)


def test_parity_distance_is_a_lower_bound():
    r = np.random.default_rng(1)
    for _ in range(30):
        a = np.unique(r.integers(0, 1 << 63, 200, dtype=np.uint64))
        b = np.unique(np.append(a[r.random(len(a)) < 0.8], r.integers(0, 1 << 63, 20, dtype=np.uint64)))
        x, y = (np.frombuffer(parity_bits(s), np.uint8) for s in (a, b))
        width = min(len(x), len(y))
        fold = [np.bitwise_xor.reduce(v.reshape(-1, width), axis=0) for v in (x, y)]
        assert np.bitwise_count(fold[0] ^ fold[1]).sum() <= len(np.setxor1d(a, b))


def test_components_of_chains_and_hubs(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (300, 300), (None, 5)]
    found = dict(map(tuple, connected_components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()))
    assert found == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 160), 100), 300: 300}
