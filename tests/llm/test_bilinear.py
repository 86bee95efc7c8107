"""Base scores against plain counting; the model is normalised and better on held-out text."""

import collections
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from llm import bilinear
from llm.bilinear import CLASSES, Classes, Scorer, contexts, score_texts, start_parameters
from llm.words import Hasher

R = random.Random(9)


def text():
    low = R.choice(["a", "b"])
    return " ".join(f"{low}{int(R.paretovariate(0.8)) % 3000}" for _ in range(R.randint(20, 150)))


ROWS = [(k, text()) for k in range(400)] + [(1, "A1 a1"), (1, "A1 a1"), (500, None), (501, ""), (502, "unseen! é " * 30), (None, "b1")]


@pytest.mark.parametrize("common", [1 << 17, 50])
def test_scores(spark, monkeypatch, common):
    monkeypatch.setattr(bilinear, "COMMON", common)
    docs = spark.createDataFrame([(a, b, 1) for a, b in ROWS], "doc_id long, text string, score int")
    rows = score_texts(docs.repartition(3)).collect()
    assert len(rows) == len(ROWS)
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    tokens = lambda t: [*(t or "").encode().lower().split(), None]
    counts = collections.Counter(w for i, t in ROWS if not held(i) for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    want = sorted(
        ((i or -1), held(i), len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), n, round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens(t)), 6))
        for i, t in ROWS
    )
    names = ("held_out", "n_tokens", "n_known", "train_tokens")
    assert sorted(((r["doc_id"] or -1), *(r[c] for c in names), round(r["base_score"], 6)) for r in rows) == want
    out = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)


def test_classes_sum_to_one_in_every_context():
    scorer = Scorer(start_parameters(np.arange(1.0, CLASSES + 1)), Classes([]), np.zeros(0, np.uint64), np.zeros(0), np.zeros(CLASSES))
    logs = scorer.first[3][None, :] + scorer.second - scorer.log_z[3][:, None]
    assert np.allclose(np.exp(logs).sum(axis=1), 1, atol=1e-4)


def test_contexts_stay_within_a_text():
    words, bounds = Hasher().words(pa.array(["x y", None, "z"]))
    token, two, one, row = contexts(np.array([5, 6, 7]), bounds)
    assert token.tolist() == [5, 6, 0, 0, 7, 0] and one.tolist() == [0, 5, 6, 0, 0, 7]
    assert two.tolist() == [0, 0, 5, 0, 0, 0] and row.tolist() == [0, 0, 0, 1, 2, 2]


def test_empty_table(spark):
    assert score_texts(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_the_score_by_hand_and_words_sum_to_one(spark, monkeypatch):
    kept, made = [], Scorer.__init__
    monkeypatch.setattr(Scorer, "__init__", lambda self, *args: made(self, *args) or kept.append(self))
    monkeypatch.setattr(bilinear, "COMMON", 60)
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    rows = {(r["doc_id"], r["n_tokens"]): r["score"] for r in score_texts(docs).collect()}
    (scorer,) = kept
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    split = lambda t: (t or "").lower().split()
    counts = collections.Counter(w for i, t in ROWS if not held(i) for w in split(t))

    def kinds(ws):
        hashes, _, lengths, last = Hasher().words(pa.array([" ".join(ws)]), tails=True)
        return scorer.classes.of(hashes, lengths, last).tolist()

    kind = dict(zip(counts, kinds(list(counts)), strict=True))
    size, number = collections.Counter(), collections.Counter()
    for w, n in counts.items():
        size[kind[w]] += n
        number[kind[w]] += 1
    of_class = lambda two, one, k: (scorer.first[two, k] + scorer.second[one, k] - scorer.log_z[two, one]) / math.log(10)

    def inside(w, k):
        return 0.0 if k <= bilinear.FREQUENT else math.log10((counts[w] + 1) / (size[k] + number[k] + 1))

    for i, t in ROWS[:40] + ROWS[-4:-1]:
        ws = split(t)
        total, two, one = 0.0, 0, 0
        for w, k in [*zip(ws, kinds(ws) if ws else [], strict=True), (None, 0)]:
            total += float(of_class(two, one, k)) + (inside(w, k) if w else 0.0)
            two, one = one, k
        assert math.isclose(rows[i, len(ws) + 1], total, rel_tol=1e-4, abs_tol=1e-3)
    # All words met, one unseen word of each class of shapes, and the end.
    for two, one in ((0, 0), (3, 9), (500, 1)):
        share = {k: 10 ** float(of_class(two, one, k)) for k in range(CLASSES)}
        words = sum(share[k] * 10 ** inside(w, k) for w, k in kind.items())
        unseen = sum(share[k] / (size[k] + number[k] + 1) for k in range(bilinear.FREQUENT + 1, CLASSES))
        unused = sum(share[k] for k in range(1, bilinear.FREQUENT + 1) if k not in set(kind.values()))
        assert math.isclose(words + unseen + unused + share[0], 1, rel_tol=1e-3)
