"""Planted passages are found, clean texts are not; the index loses no fingerprint in its radius."""

import random
from collections import Counter

import numpy as np

from llm import decontaminate
from llm.decontaminate import BLOCKS, RADIUS, Benchmark, contaminated, without_benchmark

R = random.Random(2)
WORDS = [f"w{k}" for k in range(400)]


def prose(n):
    return [R.choice(WORDS) for _ in range(n)]


ITEMS = [(k, " ".join(prose(n))) for k, n in enumerate([40, 40, 12, 60, 7])] + [(20, "only three words"), (21, None), (22, " "), (23, "")]


def planted(item, edits=0):
    words = dict(ITEMS)[item].split()
    for at in range(3, 3 + 9 * edits, 9):
        words[at] = "changed"
    return " ".join([*prose(30), *words, *prose(25)])


DOCS = [
    (1, planted(0)),
    (1, planted(0)),
    (2, planted(3, 1).upper()),
    (3, planted(1) + " " + planted(2)),
    (4, " ".join(prose(300))),
    (5, None),
    (6, ""),
    (7, "here only three words again"),
    (8, dict(ITEMS)[4]),
    (9, " ".join([*prose(30), *dict(ITEMS)[0].split()[:20], *prose(30)])),
]


def test_planted_passages(spark, monkeypatch):
    docs = spark.createDataFrame([(a, b, 0) for a, b in DOCS], "doc_id long, text string, item_id int")
    items = spark.createDataFrame([(a, b, 0) for a, b in ITEMS], "item_id long, text string, doc_id int")
    want = [(1, 0), (1, 0), (2, 3), (3, 1), (3, 2), (7, 20), (8, 4)]
    for bound in (decontaminate.SLICE_BYTES, 200):
        monkeypatch.setattr(decontaminate, "SLICE_BYTES", bound)
        rows = contaminated(docs, items).collect()
        assert sorted((r["doc_id"], r["item_id"]) for r in rows) == want
        kept = without_benchmark(docs, items)
        assert sorted(r["doc_id"] for r in kept.collect()) == [4, 5, 6, 9] and kept.columns == docs.columns
    exact = next(r for r in rows if r["doc_id"] == 1)
    assert (exact["start_word"], exact["n_words"], exact["hamming"], exact["similarity"]) == (30, 40, 0, 1.0)


def test_an_edited_copy_of_a_text_that_several_items_hold(spark):
    text = prose(40)
    edited = [*text[:20], "changed", *text[21:]]  # plain similarity 31 / 41
    docs = spark.createDataFrame([(1, " ".join([*prose(30), *edited, *prose(25)])), (2, " ".join(prose(300)))], "doc_id long, text string")
    for holders in (1, 2, 3, 10):
        items = spark.createDataFrame([(k, " ".join(text)) for k in range(holders)], "item_id long, text string")
        rows = contaminated(docs, items).collect()
        assert sorted((r["doc_id"], r["item_id"], r["start_word"]) for r in rows) == [(1, k, 30) for k in range(holders)]
        assert all(abs(r["similarity"] - 31 / 41) < 1e-9 for r in rows)
        assert [r["doc_id"] for r in without_benchmark(docs, items).collect()] == [2]


def test_empty_tables(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert contaminated(docs.limit(0), items).collect() == [] and contaminated(docs, items.limit(0)).collect() == []
    assert without_benchmark(docs, items.limit(0)).count() == len(DOCS)


NONE = np.zeros(0, np.uint64), np.zeros(0)


def flipped(prints, rng, bits):
    flips = rng.choice(128, bits, replace=False)
    out = prints.copy()
    for f in flips.tolist():
        out[f // 32] ^= np.uint32(1 << (f % 32))
    return out


def test_the_index_yields_all_within_the_radius():
    bench = Benchmark([(k, " ".join(prose(30))) for k in range(50)], NONE)
    rng, every = np.random.default_rng(5), np.arange(50)
    for _ in range(60):
        item, bits = int(rng.integers(50)), int(rng.integers(0, 55))
        got = {k: d for _, k, d in bench.near(flipped(bench.prints[False][item], rng, bits)[None, :], every)}
        assert got.get(item) == (bits if bits <= RADIUS else None)
        assert all(d <= RADIUS for d in got.values())


def test_the_index_lets_few_unrelated_fingerprints_through():
    rng = np.random.default_rng(6)
    ours, theirs = rng.integers(0, 1 << 32, (2, 1500, BLOCKS), dtype=np.uint32)
    met = np.zeros((1500, 1500), bool)
    for b in range(BLOCKS):
        met |= np.bitwise_count(ours[:, b, None] ^ theirs[None, :, b]) <= RADIUS // BLOCKS
    assert met.mean() < 0.15


def shingle_counts(words):
    n = min(5, len(words))
    return Counter(tuple(words[k : k + n]) for k in range(len(words) - n + 1)) if words else Counter()


def by_all_windows(docs, items):
    """(doc, item) -> best similarity over all windows, none left out."""
    counts = {i: shingle_counts(t.split()) for i, t in items}
    holders = Counter(h for c in counts.values() for h in c)
    out = {}
    for d, text in docs:
        words = text.lower().split()
        for i, t in items:
            n = len(t.split())
            for start in range(max(1, len(words) - n + 1)):
                ours, theirs = shingle_counts(words[start : start + n]), counts[i]
                best = 0.0
                for weight in (lambda h: 1.0, lambda h: 1.0 / holders.get(h, 1)):
                    more = sum(weight(h) * max(ours[h], theirs[h]) for h in ours.keys() | theirs.keys())
                    less = sum(weight(h) * min(ours[h], theirs[h]) for h in ours.keys() & theirs.keys())
                    best = max(best, less / more if more else 0.0)
                if best >= 0.75:
                    out[d, i] = max(best, out.get((d, i), 0.0))
    return out


def test_recall_against_all_windows_whatever_the_slices(spark, monkeypatch):
    r = random.Random(9)
    common = prose(14)
    items = [(k, " ".join(prose(24) + (common if k % 3 else []) + prose(r.randint(0, 12)))) for k in range(30)]
    items += [(40, items[0][1]), (41, items[1][1] + " more")]
    docs = []
    for k in range(150):
        words = dict(items)[r.choice([i for i, _ in items])].split()
        for _ in range(r.randint(0, 3)):  # edits that take the similarity to either side of the bound
            words[r.randrange(len(words))] = "changed"
        docs.append((k, " ".join([*prose(r.randint(0, 20)), *words, *prose(r.randint(0, 20))])))
    want = by_all_windows(docs, items)
    assert len(want) > 80
    texts = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    results = []
    for bound in (decontaminate.SLICE_BYTES, 1000):
        monkeypatch.setattr(decontaminate, "SLICE_BYTES", bound)
        results.append({(x["doc_id"], x["item_id"]): x["similarity"] for x in contaminated(texts, bench).collect()})
    assert results[0] == results[1]
    assert results[0].keys() <= want.keys() and len(results[0]) >= 0.99 * len(want)
    close = [abs(s - want[k]) < 1e-9 for k, s in results[0].items()]
    assert sum(close) >= 0.99 * len(close)
