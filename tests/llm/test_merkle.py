"""Digests, proofs and the verdict on changed texts against a plain tree over all rows."""

import hashlib
import random
import zlib

import numpy as np

from llm.merkle import Manifest, manifest, missing, proof_digest, proofs

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(i, text, lang, source, n):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, source, lang, n, text)))


def levels(digests):
    out = [digests]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][k : k + 8])) for k in range(0, len(out[-1]), 8)])
    return out


def way(tree, k):
    out = []
    for row in tree[:-1]:
        at = k // 8 * 8
        out.append(("".join(row[at:k]), "".join(row[k + 1 : at + 8])))
        k //= 8
    return out


def lower(text):
    return None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def plain(rows):
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    own = {x: sorted((r for r in rows if r[2] == x), key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(*r))) for x in langs}
    trees = {x: levels([leaf_of(*r) for r in own[x]]) for x in langs}
    top = levels([trees[x][-1][0] for x in langs])
    out = []
    for x in langs:
        for k, r in enumerate(own[x]):
            up = way(trees[x], k) + way(top, langs.index(x))
            changed = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            now = leaf_of(r[0], lower(r[1]) if changed else r[1], *r[2:])
            for a, b in up:
                now = sha(a + now + b)
            out.append((r[0], leaf_of(*r), trees[x][-1][0], top[-1][0], sha("".join(a + b for a, b in up)), now, now == top[-1][0]))
    return out


def odd_rows():
    r = random.Random(12)
    rows = [(k, r.choice(["Aé Z", "b", "", None, "L" * 50_000]) if k % 7 else f"Text {k}", r.choice(["en"] * 8 + ["fr", "é", None]), r.choice(["s", None]), r.choice([k, None])) for k in range(1300)]
    rows += [(5, "again", "en", "s", 1), (5, "again", "en", "s", 1), (5, "Again", "en", "s", 1), (None, "no id", "en", None, None), (None, None, None, None, None)]
    return rows + [(-3, "One ALONE", "zz", "s", 0), (7, "x", "", "", 0)]


key = lambda r: tuple(map(str, r))


def test_every_column_against_plain_trees(spark):
    rows = odd_rows()
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS leaf", "'p' AS pos", "'t' AS tree", "0 AS now")
    found = proof_digest(docs).collect()
    assert sorted(map(tuple, found), key=key) == sorted(plain(rows), key=key)
    verdicts = {r.verified for r in found}
    assert verdicts == {True, False}


def test_one_row_no_row_and_one_run(spark):
    for n in (0, 1, 8, 9):
        rows = [(k, f"T{k}", "en", "s", k) for k in range(n)]
        assert sorted(map(tuple, proof_digest(spark.createDataFrame(rows, SCHEMA)).collect())) == sorted(plain(rows))


def test_some_rows_have_the_same_proofs_as_all(spark, tmp_path):
    book = manifest(spark.createDataFrame(odd_rows(), SCHEMA))
    book.write(str(tmp_path / "book"))
    book = Manifest.read(spark, str(tmp_path / "book"))
    every = {(r.doc_id, r.leaf, r.pos): r for r in proofs(book).collect()}
    some = proofs(book, book.leaves.where("doc_id % 97 = 3 OR doc_id < 0")).collect()
    assert len(some) > 10
    for r in some:
        assert r.verified and r.siblings == every[r.doc_id, r.leaf, r.pos].siblings


def test_missing_nodes_are_the_least_that_do(spark):
    r = np.random.default_rng(2)
    for width in (1, 2, 8, 9, 70, 600):
        chosen = np.unique(r.integers(0, width, 5))
        got = [set(x.tolist()) for x in missing(chosen, width)]
        known, n = set(chosen.tolist()), width
        for level in got:
            runs = {p // 8 for p in known}
            assert level == {p for run in runs for p in range(run * 8, min(run * 8 + 8, n))} - known
            known, n = runs, -(-n // 8)
        assert n == 1
