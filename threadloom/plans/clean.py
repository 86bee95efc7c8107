"""Clean: raw batches -> cleaned, rendered posts packed into shards."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from threadloom.operators.render import (
    clean_comments,
    clean_posts,
    measure_segments,
    post_sizes,
    render_segments,
)
from threadloom.operators.shards import (
    Budget,
    assign_shards,
    attach_shards,
    resume_shard,
    shard_ranges,
    shard_summary,
)
from threadloom.plans.ingest import RawStore, stored_batches
from threadloom.session import materialize
from threadloom.sources.batches import (
    KEYS,
    batch_order,
    flat_comments,
    flat_nodes,
    flat_posts,
    list_batches,
    pending_files,
)
from threadloom.sources.ledgers import PROCESSED, SHARDS
from threadloom.sources.runs import Attempt, read_table, until_committed
from threadloom.sources.shards import TEXT, write_shards
from threadloom.sources.split import scan_batches

COMMENTS = (
    "file_name string, post_pos int, path array<int>, comment_id string, author string,"
    " body string, created_date string, upvotes string, is_submitter boolean"
)
POSTS = (
    "file_name string, post_pos int, id string, title string, text string, author string,"
    " created_date string, upvotes string, num_comments string"
)


@dataclass(frozen=True)
class CleanStore:
    """Where the runs of cleaning live: their text, and their ledgers ``shards`` and ``processed``."""

    root: str


def processed_files(spark: SparkSession, store: CleanStore) -> DataFrame:
    """(file_name) of all batches that committed runs have processed."""
    return read_table(spark, store.root, "processed", PROCESSED)


def pack_batches(
    posts: DataFrame,
    comments: DataFrame,
    files: DataFrame,
    store: CleanStore,
    attempt: Attempt,
    budget: Budget = Budget(),
) -> DataFrame:
    """Pack cleaned posts and comments of the batches ``files`` into shards, as one run.

    Both are read several times and are expected to be materialised. Returns
    one row: posts written, files processed and the shards they went to. Text
    and ledgers are there once the run's manifest is; ``attempt`` was made before
    ``files`` were compared with what is processed, so a run in between is noticed.
    """
    spark = posts.sparkSession
    shard = resume_shard(read_table(spark, store.root, "shards", SHARDS), budget)

    segments = render_segments(posts, comments, KEYS)
    sizes = post_sizes(measure_segments(segments), KEYS).withColumn("batch", batch_order())
    placed = materialize(assign_shards(sizes, ["batch", *KEYS], budget, shard))
    shards = materialize(shard_summary(placed, KEYS))
    if not shards.isEmpty():
        placed_text = attach_shards(segments, shard_ranges(placed))
        attempt.write(TEXT, lambda folder: write_shards(placed_text, folder))
    run = F.lit(attempt.run.number).cast("bigint").alias("run_no")
    attempt.add_ledger("shards", shards.select(run, "file_no", "posts", "bytes", "words"))
    attempt.add_ledger("processed", files.select("file_name").distinct())
    attempt.commit()
    return clean_summary(shards, files, shard.file_no)


def clean_nodes(nodes: DataFrame) -> DataFrame:
    """Nodes of batch files with their texts cleaned."""
    return clean_comments(clean_posts(nodes))


def _names(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(", ")]


def clean_summary(shards: DataFrame, files: DataFrame, first_shard: int = 1) -> DataFrame:
    """One row: posts_written, files_processed, output_files.

    The shard that was open at the start counts as an output, also if all posts went to later ones.
    """
    opened = F.coalesce(F.max("file_no"), F.lit(first_shard)) - F.lit(first_shard) + 1
    written = shards.agg(
        F.coalesce(F.sum("posts"), F.lit(0)).alias("posts_written"),
        opened.cast("bigint").alias("output_files"),
    )
    processed = files.agg(F.count_distinct("file_name").alias("files_processed"))
    return written.select(
        "posts_written", processed.scalar().alias("files_processed"), "output_files"
    )


def clean_folder(
    spark: SparkSession, raw_root: str, store: CleanStore, budget: Budget = Budget()
) -> DataFrame:
    """Clean the batch files of a folder that no earlier run has processed.

    Broken and empty files count as processed and are not tried again.
    """

    def run() -> DataFrame:
        attempt = Attempt(spark, store.root)
        pending = pending_files(list_batches(spark, raw_root), processed_files(spark, store))
        pending = materialize(pending)
        if pending.isEmpty():
            return _nothing(spark)
        nodes = flat_nodes(scan_batches(spark, pending), clean_nodes)
        return pack_batches(flat_posts(nodes), flat_comments(nodes), pending, store, attempt, budget)

    return until_committed(run)


def pending_rows(raw: RawStore, table: str, pending: DataFrame) -> DataFrame:
    """The rows of a raw store's table that belong to the batches ``pending`` (file_name, run_no).

    Only folders of the ingest runs that hold such batches are opened, and the least and the
    greatest name go into the scan as a filter: each run's rows are written in ranges of
    batches, so files and row groups outside that range are passed over.
    """
    spark = pending.sparkSession
    runs = pending.groupBy("run_no").agg(F.min("file_name").alias("least"), F.max("file_name").alias("greatest")).collect()
    rows = read_table(spark, raw.root, table, None, {run.run_no for run in runs})
    least, greatest = min(run.least for run in runs), max(run.greatest for run in runs)
    return rows.filter(F.col("file_name").between(least, greatest)).join(pending, "file_name", "left_semi")


def clean_store(
    spark: SparkSession, raw: RawStore, store: CleanStore, budget: Budget = Budget()
) -> DataFrame:
    """Clean the batches of a raw store that no earlier run has processed."""

    def run() -> DataFrame:
        attempt = Attempt(spark, store.root)
        pending = pending_files(stored_batches(spark, raw), processed_files(spark, store))
        pending = materialize(pending)
        if pending.isEmpty():
            return _nothing(spark)
        posts = materialize(clean_posts(pending_rows(raw, "posts", pending).select(*_names(POSTS))))
        comments = materialize(clean_comments(pending_rows(raw, "comments", pending).select(*_names(COMMENTS))))
        return pack_batches(posts, comments, pending, store, attempt, budget)

    return until_committed(run)


def _nothing(spark: SparkSession) -> DataFrame:
    schema = "posts_written long, files_processed long, output_files long"
    return spark.createDataFrame([(0, 0, 0)], schema)
