"""Links and components against a scan of all pairs; the graph's recall."""

import numpy as np

from llm import hnsw
from llm.hnsw import Graph, near_vectors

RNG = np.random.default_rng(12)


def test_links_and_components(spark):
    x = RNG.normal(size=(500, 16))
    x[100:160] = x[100] + RNG.normal(size=(60, 16)) * 0.12  # one large group
    x[200:210] = x[200]  # equal vectors
    x[210] = x[200] * 3
    rows = [(k, v.tolist(), 0) for k, v in enumerate(x.astype(np.float32))]
    odd = [None, [], [0.0] * 16, [None, *[1.0] * 15], [float("nan"), *[1.0] * 15], [float("inf"), *[1.0] * 15], [1.0, 2.0]]
    rows += [(1000 + k, v, 0) for k, v in enumerate(odd)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, n_links int")
    found = {r["vec_id"]: r for r in near_vectors(table.repartition(3), shards=3, parts=2).collect()}
    u = x.astype(np.float32).astype(float)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    linked = u @ u.T >= 0.9
    np.fill_diagonal(linked, False)
    least = np.arange(500)
    while True:
        new = np.minimum(least, np.where(linked, least[None, :], 500).min(axis=1))
        if (new == least).all():
            break
        least = new
    assert [found[k]["n_links"] for k in range(500)] == linked.sum(axis=1).tolist()
    assert [found[k]["component_id"] for k in range(500)] == least.tolist()
    assert all(found[k]["n_links"] == 0 and found[k]["kept"] for k in range(1000, 1000 + len(odd)))
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in found.values())


def test_groups_stay_bounded_as_the_table_grows(spark, monkeypatch):
    monkeypatch.setattr(hnsw, "SHARD_BYTES", 100 * (16 * 8 + 512))
    monkeypatch.setattr(hnsw, "PART_BYTES", 200 * 16 * 8)
    rows = spark.range(90).selectExpr("16 AS dim")
    assert [tuple(r) for r in hnsw.slices(rows).collect()] == [(16, hnsw.SHARDS, hnsw.PARTS)]
    monkeypatch.setattr(hnsw, "SHARDS", 1)
    monkeypatch.setattr(hnsw, "PARTS", 1)
    sizes = {}
    for n in (90, 1000, 4000):
        rows = spark.range(n).selectExpr("16 AS dim").union(spark.range(3).selectExpr("8 AS dim"))
        sizes[n] = {r["dim"]: (r["shards"], r["parts"]) for r in hnsw.slices(rows).collect()}
    assert sizes == {90: {16: (1, 1), 8: (1, 1)}, 1000: {16: (10, 5), 8: (1, 1)}, 4000: {16: (40, 20), 8: (1, 1)}}
    x = RNG.normal(size=(600, 16))
    x[300:] = x[:300] + RNG.normal(size=(300, 16)) * 0.02
    table = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = {r["vec_id"]: r["component_id"] for r in near_vectors(table).collect()}
    assert all(found[k] == found[300 + k] for k in range(300))


def test_empty_table(spark):
    assert near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []


def test_recall_of_the_graph():
    x = RNG.normal(size=(2000, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    graph = Graph(x)
    near = x + RNG.normal(size=x.shape) * 0.03
    near /= np.linalg.norm(near, axis=1, keepdims=True)
    beam = graph.audited(near)
    found = graph.search(near, beam)
    hits = [k in f for k, f in enumerate(found) if near[k] @ x[k] >= 0.9]
    assert len(hits) > 1500 and np.mean(hits) >= 0.98


def test_planted_links_over_several_shards(spark):
    # Pairs at every cosine from 0.85 to 1, so that some are links and some just are not.
    x = RNG.normal(size=(3000, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    aside = RNG.normal(size=x.shape)
    aside -= (aside * x).sum(axis=1, keepdims=True) * x
    aside /= np.linalg.norm(aside, axis=1, keepdims=True)
    cosine = np.linspace(0.85, 1, len(x))[:, None]
    both = np.concatenate([x, cosine * x + np.sqrt(1 - cosine**2) * aside])
    table = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(both)], "vec_id long, embedding array<double>")
    found = {r["vec_id"]: r for r in near_vectors(table, shards=6, parts=2).collect()}
    sims = both @ both.T
    np.fill_diagonal(sims, 0)
    links = (sims >= 0.9).sum(axis=1)
    got = np.array([found[k]["n_links"] for k in range(len(both))])
    assert (got <= links).all() and got.sum() >= 0.99 * links.sum()


def test_one_id_twice(spark):
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [0.0, 1.0])]
    found = near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in found) == [(1, 1, 1), (1, 1, 1), (1, 1, 1), (2, 1, 1)]
