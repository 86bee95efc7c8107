"""The shard sink: ordered text under one folder per shard."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from threadloom.functions.measures import word_count
from threadloom.sources.batches import batch_order
from threadloom.sources.runs import folders, read_table

WITHIN = ["file_name", "post_pos", "seg", "path"]


TEXT = "text"
LINES = "file_no long, run_no long, part string, value string"


def write_shards(segments: DataFrame, folder: str) -> None:
    """Write segments that carry ``file_no`` as text of one run, in order.

    Rows are range partitioned on the full order, so tasks are even however
    large a single post or shard is. A shard cut by a partition border, or
    continued by a later run, has several part files; (run_no, part name) sorts
    in the order of the text. Batches stand by number.
    """
    order = ["file_no", batch_order(), *WITHIN]
    (
        segments.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("file_no", F.col("text").alias("value"))
        .write.partitionBy("file_no")
        .text(folder)
    )


def read_shards(spark: SparkSession, root: str) -> DataFrame:
    """(file_no, run_no, part, value): the lines of all shards of a store's committed runs.

    Lines within a part file are in order; parts sort by (file_no, run_no, part).
    """
    paths = folders(spark, root, TEXT)
    if not paths:
        return spark.createDataFrame([], LINES)
    return spark.read.option("basePath", f"{root}/{TEXT}").text(paths).select(
        F.col("file_no").cast("bigint").alias("file_no"),
        F.col("run_no").cast("bigint").alias("run_no"),
        F.col("_metadata.file_name").alias("part"),
        "value",
    )


def shard_words(spark: SparkSession, root: str) -> DataFrame:
    """(file_no, words) counted in the text itself; words add up over lines."""
    lines = read_shards(spark, root)
    return lines.groupBy("file_no").agg(F.sum(word_count(F.col("value"))).alias("words"))


def shard_sizes(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """(file_no, bytes) of all shards, adopted ones too, from the ledger alone."""
    ledger = read_table(spark, root, "shards", schema)
    return ledger.groupBy("file_no").agg(F.sum("bytes").alias("bytes"))
