"""Ids against the library, plans against exact best fills, placement without gaps or loss."""

import itertools
import random

import numpy as np
import pytest

pytest.importorskip("public_tokenizers")

from llm.packing import WordTokenizer, default_tokenizer, fullest, pack_documents, plan, sequences  # noqa: E402

R = random.Random(3)
TEXTS = [
    "a\x1cb c",
    "don't STOP... it's 1st, x-y (é!) ÉÉ,, 'll, a--",
    "一 x一y 一",
    "é, É! THE the*** The,",
    "İstanbul, ΣΑΣ. <|endoftext|> q",
    "",
    "   x\n",
    "word " * 3000 + "end",
    "".join(R.choice("abAB'é,. \t1一") for _ in range(3000)),
]


def ids_of(text):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(default_tokenizer())
    whole.encode_special_tokens = True
    return whole.encode(text or "", add_special_tokens=False).ids


def test_ids_are_those_of_the_library():
    ours = WordTokenizer(default_tokenizer())
    for _ in range(2):
        for text, data in zip(TEXTS, ours.texts(TEXTS), strict=True):
            assert np.frombuffer(data, "<u4").tolist() == ids_of(text)


def test_fullest_is_the_best_fill():
    for _ in range(60):
        room = R.randint(1, 30)
        lengths = [R.randint(1, 20) for _ in range(R.randint(0, 7))]
        counts = np.bincount(lengths, minlength=40)
        chosen = fullest(counts, room)
        best = max(s for n in range(len(lengths) + 1) for c in itertools.combinations(lengths, n) if (s := sum(c)) <= room)
        assert sum(k * n for k, n in chosen.items()) == best and all(n <= counts[k] for k, n in chosen.items())


def test_plan_covers_each_length_once():
    # Short pieces: longer than half a sequence, each would need one of its own.
    histogram = {R.randint(1, 20): R.randint(1, 500) for _ in range(30)}
    table = plan(histogram, 64)
    for length, n in histogram.items():
        rows = table[table[:, 0] == length]
        assert rows[:, 2].sum() == n and (rows[:, 1] == np.append(0, np.cumsum(rows[:-1, 2]))).all()
    sequences_used = max(s + n // m for _, _, n, m, s, _ in table.tolist())
    assert sequences_used <= -(-sum(k * n for k, n in histogram.items()) // 64) + 2


def test_placement_and_round_trip(spark):
    rows = [(k, t, "x") for k, t in enumerate([*TEXTS, None])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, piece string")
    placed = pack_documents(docs, default_tokenizer(), capacity=1000)
    rows = placed.collect()
    want = {k: [*ids_of(t), 1] for k, t in enumerate([*TEXTS, None])}
    for doc_id, ids in want.items():
        own = sorted((r for r in rows if r["doc_id"] == doc_id), key=lambda r: r["piece"])
        assert [r["start"] for r in own] == list(range(0, len(ids), 1000)) and sum(r["length"] for r in own) == len(ids)
    packed = {r["sequence_id"]: np.frombuffer(r["ids"], "<u4").tolist() for r in sequences(docs, placed, default_tokenizer()).collect()}
    for sequence, ids in packed.items():
        own = sorted((r for r in rows if r["sequence_id"] == sequence), key=lambda r: r["offset"])
        assert ids == [i for r in own for i in want[r["doc_id"]][r["start"] : r["start"] + r["length"]]]
        assert len(ids) <= 1000 and [r["offset"] for r in own] == list(np.cumsum([0, *(r["length"] for r in own)])[:-1])
    total = sum(map(len, want.values()))
    assert len(packed) == -(-total // 1000)


def test_repeats_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")] * 3 + [(None, "a b")], "doc_id long, text string")
    rows = pack_documents(docs, default_tokenizer(), capacity=6).collect()
    assert sorted(r["offset"] for r in rows) == [0, 0, 3, 3]
    assert pack_documents(docs.limit(0), default_tokenizer()).collect() == []
