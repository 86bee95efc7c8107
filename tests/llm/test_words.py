"""Word hashes and shingles against plain Python."""

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from llm.words import CHUNK, Hasher, pieces, shingle_sets, shingles

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aAbBéÉ \t\n\x0b\x1c.,", max_size=40)), max_size=8)


def plain(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_words_are_those_of_the_pattern(texts):
    hashes, bounds = Hasher().words(pa.array(texts, pa.string()))
    words = [plain(t) for t in texts]
    assert np.diff(bounds).tolist() == [len(w) for w in words]
    names = {}
    for word, h in zip([w for row in words for w in row], hashes.tolist(), strict=True):
        assert names.setdefault(word, h) == h
    assert len(set(names.values())) == len(names)


def test_long_texts_are_cut_at_white_space_only():
    long = "ab " * CHUNK + "c" * (2 * CHUNK) + " end"
    hashes, bounds = Hasher().words(pa.array([long, "end", None]))
    assert np.diff(bounds).tolist() == [CHUNK + 2, 1, 0]
    assert hashes[-1] == hashes[-2] and len(set(hashes.tolist())) == 3


def test_sliced_columns_and_short_texts():
    column = pa.array(["x", "a b", "A  B", "a b c d e f", ""]).slice(1)
    sets = [s.tolist() for s in shingle_sets(column, Hasher())]
    assert sets[0] == sets[1] and len(sets[0]) == 1 and len(sets[2]) == 2 and sets[3] == []
    assert [len(p) for p in pieces(column, 3)] == [3, 1]
    assert len(shingles(np.zeros(0, np.uint64))) == 0
