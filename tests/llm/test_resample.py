"""Selection on labelled texts; the k-th largest; odd inputs."""

import random

import numpy as np

from llm.resample import Selection, break_even, kth_largest, select_rows, selected

R = random.Random(6)
GOOD = [f"g{k}" for k in range(80)]
SIGNS = ["###", "$$$"]


def text(good):
    return " ".join(R.choice(GOOD) + ("" if good else R.choice(SIGNS)) for _ in range(R.randint(5, 120)))


DOCS = [(k, text(k % 5 != 0)) for k in range(600)]


def tables(spark):
    docs = spark.createDataFrame([(a, b, 0.5) for a, b in [*DOCS, (None, text(True)), (1000, None), (1001, " ")]], "doc_id long, text string, key double")
    labels = [(k, int(k % 5 != 0), 9.0) for k in range(0, 600, 2)] + [(None, 1, 0.0), (3, None, 0.0), (7, 5, 0.0)]
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, log_weight double")


def test_good_texts_stay_and_bad_ones_go(spark):
    docs, labels = tables(spark)
    kept = select_rows(docs, labels)
    assert kept.columns == docs.columns
    ids = {r["doc_id"] for r in kept.collect()}
    good, bad = {k for k, _ in DOCS if k % 5}, {k for k, _ in DOCS if not k % 5}
    assert len(good & ids) >= 0.98 * len(good) and len(bad & ids) <= 0.02 * len(bad) and not {1000, 1001} & ids
    found = selected(docs, labels)
    assert {r["doc_id"] for r in found.collect()} == ids
    fitted = Selection(docs, labels)
    assert found.count() == fitted.k


def test_without_labels_all_texts_with_words_are_selected(spark):
    docs, labels = tables(spark)
    assert selected(docs, labels.limit(0)).count() == len(DOCS) + 1
    assert selected(docs.limit(0), labels).collect() == []


def test_kth_largest(spark):
    values = [R.choice([1.0, 2.5, R.random() * 100]) for _ in range(3000)] + [float("-inf")] * 5
    keys = spark.createDataFrame([(v,) for v in values], "v double")
    for k in (1, 2, 700, 2999, 3000):
        assert kth_largest(keys, "v", k, keep=20, bins=16) == sorted(values, reverse=True)[k - 1]


def test_break_even():
    weights = np.array([-9.0, -8.0, 1.0, 2.0, 3.0])
    assert -8 < break_even(weights, weights > 0) < 1
    assert break_even(weights, weights > -99) < -9
