"""Reports on what is stored: one row each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from threadloom.plans.clean import CleanStore, processed_files
from threadloom.plans.ingest import RawStore, stored_batches
from threadloom.sources.batches import list_batches
from threadloom.sources.ledgers import SHARDS, stored_state
from threadloom.sources.shards import shard_sizes


def clean_stats(raw_files: DataFrame, processed: DataFrame, outputs: DataFrame) -> DataFrame:
    """All raw files, processed files, shards and their bytes, in one row."""
    raw = raw_files.agg(F.count_distinct("file_name"))
    done = processed.agg(F.count_distinct("file_name"))
    return outputs.agg(
        F.count_distinct("file_no").alias("output_files"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("total_output_size"),
    ).select(
        raw.scalar().alias("raw_files"),
        done.scalar().alias("processed_files"),
        "output_files",
        "total_output_size",
    )


def run_summary(state: DataFrame, stats: DataFrame, community: str) -> DataFrame:
    """State of ingest and statistics of cleaning, in one row."""
    megabytes = F.col("total_output_size") / F.lit(1024 * 1024)
    return stats.select(
        F.lit(community).alias("community"),
        state.select("total_posts").scalar().alias("total_posts"),
        "raw_files",
        "processed_files",
        "output_files",
        F.round(megabytes, 2).alias("total_megabytes"),
        state.select("last_run").scalar().alias("last_run"),
    )


def store_stats(spark: SparkSession, raw: RawStore | str, store: CleanStore) -> DataFrame:
    """``clean_stats`` of a raw store, or of a folder of batch files."""
    files = list_batches(spark, raw) if isinstance(raw, str) else stored_batches(spark, raw)
    return clean_stats(files, processed_files(spark, store), shard_sizes(spark, store.root, SHARDS))


def store_summary(
    spark: SparkSession, raw: RawStore, store: CleanStore, community: str
) -> DataFrame:
    """The summary shown after a run."""
    state = stored_state(spark, raw.root)
    return run_summary(state, store_stats(spark, raw, store), community)
