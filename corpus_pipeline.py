"""A training corpus from raw documents: each stage reads what the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from llm.decontaminate import without_benchmark
from llm.jaccard_join import one_of_each
from llm.packing import default_tokenizer, pack_documents
from llm.pii import redact
from llm.resample import select_rows
from llm.shared import stage


def select_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling selects stay."""
    return select_rows(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return one_of_each(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return without_benchmark(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; all documents stay."""
    redacted = redact(docs)
    return redacted.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are packed into token sequences: one row per piece, with its place."""
    return pack_documents(docs, default_tokenizer())


STAGES = [
    ("quality classifier", select_quality),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_benchmark),
    ("PII", redact_pii),
    ("best-fit packing", pack),
]

#: The stages train, search and pack; SQL expresses none of that.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written as Parquet and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
