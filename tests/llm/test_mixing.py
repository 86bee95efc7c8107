"""Targets and words taken against the SQL twin on odd tables; the mix itself, row by row."""

import random

import duckdb
import pandas as pd
import pytest

from llm.mixing import mixed, mixture
from llm.oracles import ORACLES

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def table(rows):
    return [(i, t, "en", s, None) for i, t, s in rows]


def odd_rows():
    r = random.Random(11)
    rows = [(k, " ".join("w" * r.randint(1, 3) for _ in range(r.randint(0, 40))), r.choice(["big"] * 9 + ["é", "Z", "a", None])) for k in range(300)]
    rows += [(900, "same words here", "rep")] * 5 + [(None, "no id at all", "rep")] * 2
    rows += [(901, None, "void"), (902, "", "void"), (903, " \t\n", None), (904, "one", "tiny"), (905, "x " * 20_000, "long")]
    return table(rows)


def by_sql(rows):
    documents = pd.DataFrame(rows, columns=["doc_id", "text", "lang", "source", "n_chars"]).astype({"doc_id": "Int64", "n_chars": "Int64"})  # noqa: F841
    return duckdb.sql(ORACLES["op11_source_mixing"]).fetchall()


key = lambda r: tuple(map(str, r))


@pytest.mark.parametrize("rows", [odd_rows(), table([(1, None, None), (2, "", "a")]), table([(1, "a b", None)])])
def test_against_sql(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    found = mixture(docs).select("doc_id", "size", "source_size", "target", "taken").collect()
    assert sorted(map(tuple, found), key=key) == sorted(by_sql(rows), key=key)


def test_sources_meet_their_targets_and_no_document_is_repeated_too_often(spark):
    rows = mixture(spark.createDataFrame(odd_rows(), SCHEMA)).collect()
    got = {}
    for r in rows:
        assert 0 <= r.taken <= 3 * r["size"]
        got.setdefault((r.source_size, r.target), []).append(r.taken)
    assert any(target == 3 * size and size for size, target in got)  # some source is clamped
    for (_, target), taken in got.items():
        assert abs(sum(taken) - target) <= 0.5
    assert abs(sum(t for _, t in got) - sum(r["size"] for r in rows)) < 1e-6 * len(rows)


def test_the_mix_itself(spark):
    rows = odd_rows()
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS src", "2 AS words", "'k' AS own", "'t' AS target")
    out = mixed(docs).collect()
    assert list(out[0].asDict()) == [*docs.columns, "repetition"]
    taken = {}
    for r in mixture(docs).collect():
        taken[r.doc_id, r["size"]] = taken.get((r.doc_id, r["size"]), 0) + r.taken
    texts = {}
    for i, t, *_ in rows:
        texts.setdefault(i, set()).add(t)
    whole, words = {r[0]: len((r[1] or "").split()) for r in rows}, {}
    for r in out:
        assert any(t and t.startswith(r.text) for t in texts[r.doc_id])
        words[r.doc_id, whole[r.doc_id]] = words.get((r.doc_id, whole[r.doc_id]), 0) + len(r.text.split())
    assert words == {k: n for k, n in taken.items() if n}


def test_an_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert mixture(docs).collect() == [] and mixed(docs).collect() == []


def test_reruns_agree(spark):
    docs = spark.createDataFrame(odd_rows(), SCHEMA)
    assert sorted(map(key, mixture(docs).collect())) == sorted(map(key, mixture(docs.repartition(7)).collect()))
