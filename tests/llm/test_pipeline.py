"""The chained pipeline: every stage's rows against a plain version of it on that stage's own input."""

import math
import os
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash

import corpus_pipeline
from llm.packing import CAPACITY, default_tokenizer
from llm.resample import BUCKETS, CARE, PASSAGE, PRIOR, Selection, hashed_ngrams, selected
from llm.words import Hasher, mix

FOLDER = "/root/testdata/sf0.001"
SPACE = " \t\n\v\f\r"


def words(text):
    return re.findall(rf"[^{SPACE}]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def runs(ws):
    n = min(5, len(ws))
    return [tuple(ws[k : k + n]) for k in range(len(ws) - n + 1)] if ws else []


def plain_selection(docs, labels):
    """Ids selected: counts, weights, break-even and draws one document at a time."""
    label = {r["doc_id"]: r["quality"] for r in labels if r["quality"] in (0, 1)}
    buckets = {i: hashed_ngrams(pa.array([t]), Hasher())[0] for i, t in docs}
    fits = {i: int(mix(np.array([i + 9], np.uint64))[0]) & 1 == 0 for i in label}
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for i, found in buckets.items():
        np.add.at(raw, found, 1)
        if label.get(i) == 1 and fits[i]:
            np.add.at(target, found, 1)
    share = (raw + 0.5) / (raw.sum() + 0.5 * BUCKETS)
    prior = min(PRIOR, target.sum() / 4 + 1)
    ratio = np.log((target + prior * share) / (target.sum() + prior) / share)
    weight = {i: PASSAGE * float(ratio[b].mean()) for i, b in buckets.items() if len(b)}
    held = [(w, label[i]) for i, w in weight.items() if i in label and not fits[i]]
    n_good, n_bad = sum(q for _, q in held), sum(1 - q for _, q in held)
    cost = {c: CARE * sum(w < c and q for w, q in held) / n_good + sum(w >= c and not q for w, q in held) / n_bad for c, _ in held}
    cuts = sorted(c for c, _ in held)
    at = min(range(len(cuts)), key=lambda k: cost[cuts[k]])
    even = (cuts[at] + cuts[max(at - 1, 0)]) / 2

    def gumbel(i):
        h = xxhash.xxh64(str(i).encode(), xxhash.xxh64(b"gumbel", 42).intdigest()).intdigest() >> 11
        return -math.log(-math.log((h + 0.5) / (1 << 53)))

    key = {i: w + gumbel(i) for i, w in weight.items()}
    k = sum(w > even for w in weight.values())
    return set(sorted(key, key=key.get, reverse=True)[:k]), weight, even


def plain_groups(docs):
    sets = {i: set(runs(words(t))) for i, t in docs}
    least = {i: i for i in sets}

    def root(i):
        while least[i] != i:
            i = least[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and 3 * len(sets[a]) <= 4 * len(sets[b]) and 3 * len(sets[b]) <= 4 * len(sets[a]):
                if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                    x, y = sorted((root(a), root(b)))
                    least[y] = x
    return {i: root(i) for i in ids}


def plain_leaks(docs, items):
    """Ids of documents with a window of plain or weighted similarity 0.75 or more to an item."""
    counts = [(len(words(t)), Counter(runs(words(t)))) for t in {t for _, t in items}]
    holders = Counter(h for _, t in items for h in set(runs(words(t))))
    by_shingle = defaultdict(set)
    for k, (_, c) in enumerate(counts):
        for h in c:
            by_shingle[h].add(k)
    out = set()
    for i, text in docs:
        ws = words(text)
        near = defaultdict(set)
        for width in {min(5, n) for n, _ in counts if n}:
            for at in range(len(ws) - width + 1):
                for k in by_shingle.get(tuple(ws[at : at + width]), ()):
                    n = counts[k][0]
                    if min(5, n) == width:  # windows without a shingle of the item have similarity 0
                        near[k].update(range(max(0, at - n + width), min(at, max(0, len(ws) - n)) + 1))
        for k, starts in near.items():
            n, theirs = counts[k]
            for s in starts:
                ours = Counter(runs(ws[s : s + n]))
                for weight in (lambda h: 1, lambda h: 1 / holders.get(h, 1)):
                    both = ours.keys() | theirs.keys()
                    less, more = (sum(weight(h) * f(ours[h], theirs[h]) for h in both) for f in (min, max))
                    if less >= 0.75 * more:
                        out.add(i)
    return out


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the given tables")
def test_every_stage_against_a_plain_version(spark, tmp_path):
    read = lambda name: spark.read.parquet(f"{FOLDER}/{name}.parquet")
    docs, inputs = read("documents"), []
    for k, (_, step) in enumerate(corpus_pipeline.STAGES):
        inputs.append({r["doc_id"]: r["text"] for r in docs.collect()} if k < 5 else None)
        step(spark, docs, FOLDER).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
    chosen, weight, even = plain_selection(list(inputs[0].items()), read("labels").collect())
    assert set(inputs[1]) == chosen and {i: inputs[0][i] for i in chosen} == inputs[1]
    good = {r["doc_id"] for r in read("labels").collect() if r["quality"] == 1} & set(inputs[0])
    assert len(good & chosen) >= 0.9 * len(good)
    groups = plain_groups(inputs[1].items())
    assert set(inputs[2]) == set(groups.values()) and len(inputs[2]) < len(inputs[1])
    leaks = plain_leaks(inputs[2].items(), [(r["item_id"], r["text"]) for r in read("benchmark").collect()])
    assert set(inputs[2]) - set(inputs[3]) == leaks and leaks
    assert set(inputs[4]) == set(inputs[3])
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    assert any(email.search(t) for t in inputs[3].values()) and not any(email.search(t) for t in inputs[4].values())
    assert all(inputs[4][i] == t for i, t in inputs[3].items() if not re.search(r"[0-9]{3}|@|token", t, re.I))
    rows, whole = docs.collect(), {}
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(default_tokenizer())
    for r in rows:
        whole[r["doc_id"]] = whole.get(r["doc_id"], 0) + r["length"]
    assert whole == {i: len(library.encode(t, add_special_tokens=False).ids) + 1 for i, t in inputs[4].items()}
    places = defaultdict(list)
    for r in rows:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in places.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))] and sum(n for _, n in parts) <= CAPACITY


def odd_tables(spark, folder):
    r = random.Random(3)
    prose = lambda n: " ".join(r.choice(["oak", "elm", "ash", "fir", "yew", "bay", "fig"]) + str(r.randint(0, 99)) for _ in range(n))
    texts = [prose(60) for _ in range(40)]
    rows = [(k, t, "en", "a", len(t)) for k, t in enumerate(texts)]
    rows += [(3, texts[3], "en", "a", 1), (None, texts[4], "en", None, None), (None, prose(50), None, None, None), (None, prose(50), None, "b", 7)]
    rows += [(60, None, None, None, None), (61, "", "fr", "b", 0), (62, " \n", "fr", "b", 2), (63, prose(30_000), "de", "b", 9), (7, prose(40), "en", "c", 3)]
    for name, table in {
        "documents": spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").selectExpr("*", "'p' AS pii", "1 AS leak", "2 AS row", "3 AS each", "4 AS _row", "5 AS key"),
        "labels": spark.createDataFrame([(k, 1, 0) for k in range(20)] + [(None, 0, 0), (70, 0, 1)], "doc_id long, quality int, toxic int"),
        "benchmark": spark.createDataFrame([(1, " ".join(texts[9].split()[5:45])), (2, None), (None, "x"), (3, "")], "item_id long, text string"),
    }.items():
        table.coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return rows


def test_odd_rows_and_clashing_columns_along_the_chain(spark, tmp_path):
    folder = str(tmp_path / "odd")
    rows = odd_tables(spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for k, (_, step) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = step(spark, docs, folder)
        assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
    kept = docs.collect()
    ids = Counter(r["doc_id"] for r in kept)
    assert all(ids[k] >= 1 for k in range(40) if k != 9) and ids[9] == 0  # 9 holds a benchmark item
    assert ids[3] == 1 and ids[7] == 2  # a repeated row once, two texts under one id both
    assert ids[None] == 2 and ids[60] == ids[61] == ids[62] == 0  # a copy without an id goes, the others stay; no words, no row
    assert ids[63] == 1 and {r["pii"] for r in kept} == {"p"} and {r["_row"] for r in kept} == {4}
    assert len(kept) < len(rows)
    assert corpus_pipeline.run(spark, folder).select("doc_id", "piece").distinct().count() > 0


def test_an_empty_table_along_the_chain(spark, tmp_path):
    folder = str(tmp_path / "empty")
    odd_tables(spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, step in corpus_pipeline.STAGES[:-1]:
        docs = step(spark, docs, folder)
        assert docs.collect() == []
    assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect() == []


def test_selection_by_hand_with_ties_and_repeated_rows(spark):
    r = random.Random(5)
    good = [" ".join(r.choice("rose lily iris tulip".split()) for _ in range(50)) for _ in range(30)]
    bad = [" ".join(r.choice("buy win cash now".split()) for _ in range(50)) for _ in range(30)]
    docs = list(enumerate(good + bad)) + [(100 + k, good[0]) for k in range(5)]  # equal weights, drawn apart
    labels = [{"doc_id": i, "quality": int(i < 30)} for i, _ in docs[:60]]
    table = spark.createDataFrame(docs + docs[:3], "doc_id long, text string")
    marks = spark.createDataFrame([(x["doc_id"], x["quality"]) for x in labels], "doc_id long, quality int")
    once = Selection(spark.createDataFrame(docs, "doc_id long, text string"), marks)
    chosen, weight, even = plain_selection(docs, labels)
    found = {x["doc_id"]: x["log_weight"] for x in once.scores.where(f"key >= double('{once.threshold}')").collect()}
    assert set(found) == chosen and math.isclose(once.break_even, even, rel_tol=1e-4)
    assert all(math.isclose(w, weight[i], rel_tol=1e-3, abs_tol=1e-2) for i, w in found.items())
    again = Counter(x["doc_id"] for x in selected(table, marks).collect())
    assert all(again[i] in (0, 2) for i in range(3))
