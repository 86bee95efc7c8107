"""Cleaning and dedup as streams: each new file once, each new id once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from threadloom.operators.shards import Budget
from threadloom.plans.clean import CleanStore, clean_nodes, pack_batches, processed_files
from threadloom.session import materialize
from threadloom.sources.batches import (
    BATCH_GLOB,
    PROGRESS_PREFIX,
    flat_comments,
    flat_nodes,
    flat_posts,
    parse_batches,
    pending_files,
    scanned_name,
)
from threadloom.sources.files import hadoop_path
from threadloom.sources.runs import Attempt, run_of, until_committed


def stream_files(spark: SparkSession, raw_root: str, files_per_trigger: int) -> DataFrame:
    """(file_name, value): one row per new batch file."""
    return (
        spark.readStream.format("text")
        .option("wholetext", "true")
        .option("pathGlobFilter", BATCH_GLOB)
        .option("maxFilesPerTrigger", files_per_trigger)
        .load(raw_root)
        .select(scanned_name(), "value")
        .filter(~F.startswith("file_name", F.lit(PROGRESS_PREFIX)))
    )


def clean_stream(
    spark: SparkSession,
    raw_root: str,
    store: CleanStore,
    checkpoint: str,
    budget: Budget = Budget(),
    files_per_trigger: int = 1000,
) -> StreamingQuery:
    """Clean the files that are new since the last start, then stop.

    The stream's checkpoint remembers the files; those that a run of another kind on the
    same store has processed are left out. Open shard and budgets carry over in the shard
    ledger. A micro-batch is one run under its own name: replayed after its run was
    committed, it does nothing.
    """
    name = hadoop_path(spark, checkpoint).toString()

    def run(files: DataFrame, batch_id: int) -> None:
        files, source = materialize(files), f"stream:{name}#{batch_id}"

        def once() -> None:
            attempt = Attempt(spark, store.root, source)
            if run_of(spark, store.root, source):
                return
            pending = materialize(pending_files(files, processed_files(spark, store)))
            if pending.isEmpty():
                return
            nodes = flat_nodes(parse_batches(pending), clean_nodes)
            pack_batches(flat_posts(nodes), flat_comments(nodes), pending, store, attempt, budget)

        until_committed(once)

    return (
        stream_files(spark, raw_root, files_per_trigger)
        .writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def dedup_stream(
    posts: DataFrame,
    event_time: str | None = None,
    keep_for: str | None = None,
    seen: DataFrame | None = None,
) -> DataFrame:
    """First occurrence of each id across all runs of a stream.

    With an event time, an id is forgotten after ``keep_for`` and state stays
    bounded; without, it is remembered for good. Ids of ``seen``, a table such as
    ``plans.ingest.seen_ids``, are dropped before they become state: what earlier runs
    of any kind have taken needs no room in the stream's own.
    """
    if seen is not None:
        posts = posts.join(seen.select("id"), "id", "left_anti").select(*posts.columns)
    if event_time and keep_for:
        return posts.withWatermark(event_time, keep_for).dropDuplicatesWithinWatermark(["id"])
    return posts.dropDuplicates(["id"])
