"""Take over the state that file-based runs left behind."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import SparkSession, functions as F

from threadloom.functions.measures import byte_size, word_count
from threadloom.plans.clean import CleanStore
from threadloom.plans.ingest import RawStore
from threadloom.session import materialize
from threadloom.sources.files import hadoop_path, path_exists
from threadloom.sources.ledgers import read_processed_file, read_progress_file, stored_state
from threadloom.sources.runs import Attempt, run_of, until_committed
from threadloom.sources.seen import add_seen

# Names in the folders of a file-based run.
PROGRESS_FILE = "scraping_progress.json"
PROCESSED_FILE = "processed_files.txt"
SHARD_GLOB = "cleaned_posts_*.txt"
SHARD_NAME = r"^cleaned_posts_([0-9]+)\.txt$"


def adopt_raw(spark: SparkSession, folder: str, store: RawStore) -> None:
    """Seen ids and the running total of a raw folder become a run of ``store``; a folder is taken over once."""
    source = f"adopt:{hadoop_path(spark, folder).toString()}"

    def run() -> None:
        attempt = Attempt(spark, store.root, source)
        if run_of(spark, store.root, source):
            return
        seen, state = read_progress_file(spark, f"{folder}/{PROGRESS_FILE}")
        add_seen(attempt, materialize(seen))
        before = stored_state(spark, store.root).first()["total_posts"]
        now = datetime.now(timezone.utc).isoformat()
        attempt.commit(total_posts=before + state.first()["total_posts"], last_run=now)

    until_committed(run)


def adopt_clean(spark: SparkSession, folder: str, store: CleanStore) -> None:
    """Processed files and shard sizes of a clean folder become a run of ``store``; a folder is taken over once.

    The next run goes on with the last shard's number and what it holds; the
    text written so far stays where it is.
    """
    source = f"adopt:{hadoop_path(spark, folder).toString()}"

    def run() -> None:
        attempt = Attempt(spark, store.root, source)
        if run_of(spark, store.root, source) or not path_exists(spark, folder):
            return
        attempt.add_ledger("processed", read_processed_file(spark, f"{folder}/{PROCESSED_FILE}"))
        # Read by line, so that a shard of any size is read in parts.
        lines = spark.read.option("pathGlobFilter", SHARD_GLOB).option("lineSep", "\n").text(folder)
        number = F.regexp_extract(F.col("_metadata.file_name"), SHARD_NAME, 1).try_cast("bigint")
        shards = (
            lines.select(number.alias("file_no"), "value")
            .filter("file_no is not null")
            .groupBy("file_no")
            .agg(
                F.count_if(F.startswith("value", F.lit("POST ID: "))).alias("posts"),
                F.sum(byte_size(F.col("value")) + 1).alias("bytes"),
                F.sum(word_count(F.col("value"))).alias("words"),
            )
        )
        attempt.add_ledger("shards", shards.select(F.lit(attempt.run.number).cast("bigint").alias("run_no"), "*"))
        attempt.commit()

    until_committed(run)
