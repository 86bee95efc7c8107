"""Every query over the small tables; those with SQL against it; the pipeline's stages in turn."""

import os

import duckdb
import pytest

import corpus_pipeline
from llm.oracles import ORACLES
from llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the given tables")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    result = con.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    found = QUERIES[name](spark, FOLDER).select(*columns).collect()
    key = lambda r: tuple(map(str, r))
    assert sorted((tuple(r) for r in found), key=key) == sorted(result.fetchall(), key=key)


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_pipeline_keeps_columns_and_drops_what_it_should(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    before = docs.count()
    for k, (_, step) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = step(spark, docs, FOLDER)
        assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        assert docs.count() <= before
        before = docs.count()
    assert not docs.where("text LIKE '%@mail%.example.com%'").head(1)
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert pieces.select("doc_id").distinct().count() == before
    assert corpus_pipeline.run(spark, FOLDER).count() == pieces.count()
