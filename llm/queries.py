"""One query per operator, over whole tables: (spark, folder of tables) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from llm.bilinear import score_texts
from llm.decontaminate import contaminated
from llm.hnsw import near_vectors
from llm.html_extract import extract
from llm.jaccard_join import jaccard_components
from llm.merkle import proof_digest
from llm.mixing import mixture
from llm.packing import default_tokenizer, pack_documents
from llm.pii import pii_digest
from llm.resample import selected
from llm.shard_tree import layout, shard_documents
from llm.url_filter import RULES, judge_urls
from llm.whitening import whitened

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def _query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


URL_RULES = [
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
]
SHARDS = 40


@_query
def op1_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Per document: personal data found, counted and listed."""
    return pii_digest(_table(spark, folder, "documents"))


@_query
def op2_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    """Per page: host and path of its url, the rule that wins and the verdict."""
    rules = spark.createDataFrame(URL_RULES, RULES)
    judged = judge_urls(_table(spark, folder, "pages").select("page_id", "url"), rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")


@_query
def op3_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Per document: its shingles and the smallest document its links reach."""
    return jaccard_components(_table(spark, folder, "documents"))


@_query
def op4_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    """Per page: its main text."""
    return extract(_table(spark, folder, "pages"))


@_query
def op5_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark items found in documents: the best window of each and its similarity."""
    return contaminated(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


@_query
def op6_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """Per document: shard and slot, and its shard among one more."""
    return shard_documents(_table(spark, folder, "documents"), layout(SHARDS))


@_query
def op7_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    """Per document: its log10 probability under a unigram base and under the trained model."""
    return score_texts(_table(spark, folder, "documents"))


@_query
def op8_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Per vector: its links, its component, and whether it is the one to keep."""
    return near_vectors(_table(spark, folder, "embeddings"))


@_query
def op9_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """The documents selected, with their weights."""
    return selected(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


@_query
def op10_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Per piece of a document: its sequence and its place there."""
    return pack_documents(_table(spark, folder, "documents"), default_tokenizer())


@_query
def op11_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Per document: its size, its source's size and target, and the words the mix takes of it."""
    return mixture(_table(spark, folder, "documents"))


@_query
def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Per document: leaf, subroot, root and proof, and what the proof says once some texts are changed."""
    return proof_digest(_table(spark, folder, "documents"))


@_query
def op13_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """Per vector and component: the vector's whitened coordinate, and measures of the fit."""
    return whitened(_table(spark, folder, "embeddings"))
